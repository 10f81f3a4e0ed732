"""Each operator against a brute-force statement of its contract, on small tables with odd rows."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vantage.llm import (fingerprints, jaccard_join, line_dedup, mixing, quality_fm, sentencepiece_bpe, suffix_arrays,
                         suffix_dedup, token_files, vector_search, window_dedup)
from vantage.llm.base import scratch, written

BASE = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE + " tail one two"), (4, None), (5, ""), (6, "a b c"), (7, "A B\tc"),
    (8, "  Shared Line Here \nown line eight is here\nshared line here"), (9, "shared line here\nx\n\nshared line here"),
    (10, "é Ünï ### 42\n" + BASE[:200]), (11, BASE.replace("word30", "other")), (12, "solo " * 400), (None, BASE),
    (13, "y" * 3000 + " " + BASE), (13, "a second row of thirteen"), (14, "<|endoftext|> it's 3 É ▁ x  y"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(TEXTS, "doc_id long, text string")
    return rows.withColumn("pos", F.lit(1)).withColumn("n_lines", F.lit("clash")).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ordered():
    return sorted(TEXTS, key=lambda r: (r[0] is None, r[0] or 0))


def test_line_dedup(docs, empty):
    owner = {}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(low)
    for d, t in TEXTS:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= 10:
                owner[key(line)] = min(d, owner.get(key(line), d))
    want = sorted((str(d), (k := [x for x in (t or "").split("\n") if d is None or owner.get(key(x), d) == d]) and "\n".join(k) or "",
                   len((t or "").split("\n")), len((t or "").split("\n")) - len(k)) for d, t in TEXTS)
    got = line_dedup.dedup_lines(docs, batches=4, fanout=2)
    assert got.columns == ["doc_id", "pos", "text", "n_lines", "n_dropped"]
    assert sorted((str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in got.collect()) == want
    assert line_dedup.dedup_lines(empty).count() == 0


@pytest.mark.parametrize("chunk_bytes", [400, 1 << 20])
def test_window_dedup(docs, empty, chunk_bytes):
    seen, want = set(), []
    texts = [r for r in ordered() if r[0] != 13]
    for d, t in texts:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i:i + 20])
            if window in seen:
                gone[i:i + 20] = [True] * 20
            seen.add(window)
        want.append((str(d), len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    got = window_dedup.dedup_windows(docs.where("doc_id IS NULL OR doc_id <> 13"), chunk_bytes=chunk_bytes).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.text) for r in got) == sorted(want)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)
    if chunk_bytes == 400:
        assert window_dedup.dedup_windows(empty).count() == 0


@pytest.mark.parametrize("chunk_bytes, hot", [(400, 200), (400, 3), (1 << 20, 200)])
def test_suffix_dedup(spark, docs, empty, chunk_bytes, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_HOT", hot)
    rng = np.random.default_rng(hot)
    texts = [r for r in ordered() if r[0] != 13]
    passage = "".join(chr(c) for c in rng.integers(97, 123, 700))
    for i in range(40):  # passages of many lengths, periodic texts, characters of several bytes
        a, n = (int(x) for x in rng.integers(0, 500, 2))
        own = "".join(chr(c) for c in rng.integers(97, 123, 60))
        texts.append((100 + i, own + passage[a:a + n] + own[::-1] + ("ab\0" * n)[:n // 3] + "é\u4e16" * (n // 40)))
    texts.sort(key=lambda r: (r[0] is None, r[0] or 0))
    seen, want = set(), []
    for d, t in texts:
        data = (t or "").encode()
        gone = np.zeros(len(data) + 2, np.int8)
        for i in range(len(data) - 99):
            if data[i:i + 100] in seen:
                gone[i + 1:i + 101] = 1
            seen.add(data[i:i + 100])
        kept = bytes(b for b, g in zip(data, gone[1:]) if not g)
        want.append((str(d), len(data), int(gone.sum()), int((np.diff(gone) == 1).sum()), kept))
    frame = spark.createDataFrame(texts, "doc_id long, text string").withColumn("kept", F.lit(1)).repartition(3)
    got = suffix_dedup.dedup_substrings(frame, chunk_bytes=chunk_bytes).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == sorted(want)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)
    if hot == 3:
        assert suffix_dedup.dedup_substrings(empty).count() == 0


def test_merged_transforms():
    rng = np.random.default_rng(7)
    for size in (16, 48, 50, 100):
        base = rng.integers(0, 3, 400).astype(np.uint8)
        shards = [base[a:a + n] for a, n in rng.integers(0, 300, (6, 2))] + [base[:0], base[:size], base]
        classes, names = suffix_arrays.merged_classes(shards, size), {}
        at = 0
        for own in shards:
            for i in range(len(own) - size + 1):
                assert names.setdefault(own[i:i + size].tobytes(), classes[at + i]) == classes[at + i]
            at += len(own)
        assert len(set(names.values())) == len(names)


def components(rows):
    sets = []
    for d, t in rows:
        words = (t or "").encode().lower().split()
        sets.append((d, {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5
                     else {tuple(words)} if words else set()))
    group = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    low = defaultdict(list)
    for g, (d, _) in zip(group, sets):
        if d is not None:
            low[g].append(d)
    return sorted((str(d), len(s), min(low[g]) if low[g] else None) for g, (d, s) in zip(group, sets))


@pytest.mark.parametrize("chunk_bytes", [500, 1 << 20])
def test_jaccard_join(spark, docs, empty, chunk_bytes):
    rng = np.random.default_rng(chunk_bytes)
    rows = list(TEXTS)
    for i in range(60):  # a group of near copies, some of which link only through others
        words = BASE.split()
        for at in rng.integers(0, 60, rng.integers(0, 3)):
            words[at] = f"new{rng.integers(0, 6)}"
        rows.append((100 + i, " ".join(words[:rng.integers(50, 61)])))
    got = jaccard_join.link_components(spark.createDataFrame(rows, "doc_id long, text string"), chunk_bytes=chunk_bytes)
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got.collect()) == components(rows)
    if chunk_bytes == 500:
        assert jaccard_join.link_components(empty).count() == 0


@pytest.mark.parametrize("block_rows", [3, 128])
def test_jaccard_join_links(spark, docs, empty, block_rows):
    rng = np.random.default_rng(block_rows)
    rows = list(TEXTS)
    for i in range(60):
        words = BASE.split()
        for at in rng.integers(0, 60, rng.integers(0, 3)):
            words[at] = f"new{rng.integers(0, 6)}"
        rows.append((100 + i, " ".join(words[:rng.integers(50, 61)])))
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
            for w in ((t or "").encode().lower().split() for _, t in rows)]
    want = sorted((str(d), sum(100 * len(a & b) >= 80 * len(a | b) for j, b in enumerate(sets) if a and b and i != j))
                  for i, ((d, _), a) in enumerate(zip(rows, sets)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.link_components(table, with_links=True, block_rows=block_rows)
    assert sorted((str(r.doc_id), r.n_links) for r in got.collect()) == want
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got.collect()) == components(rows)
    assert jaccard_join.link_components(empty, with_links=True).count() == 0


def test_jaccard_sets_stay_where_they_are(spark, monkeypatch):
    """Verifying pairs exchanges the pairs (twice for each filter), never the sets of all classes; no table is left behind."""
    plans = []

    def recorded(df, name, *more):
        if name == "links":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, name, *more)

    monkeypatch.setattr(jaccard_join, "written", recorded)
    rows = [(i, BASE.replace("word30", f"new{i // 2}") + (" tail" if i % 3 else "")) for i in range(12)] + [(90, None), (91, BASE)]
    tables, usual = spark.catalog.listTables(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = jaccard_join.link_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got) == components(rows)
    assert plans and all(p.count("Exchange hashpartitioning") <= 4 for p in plans)
    assert spark.catalog.listTables() == tables


def test_fingerprints(docs, empty):
    found = fingerprints.fingerprint_with_edits(docs, low=0.01, high=0.5).collect()
    rows = sorted({(d, t or "") for d, t in TEXTS if d not in (None, 13)})
    by = {r.doc_id: r for r in found if r.doc_id not in (None, 13)}
    for (d, t), (e, u) in zip(rows, rows[1:]):
        if e != 14:  # two rows share the id before
            half = len(t) // 2
            assert (by[d].n_chars, by[d].edited) == (len(t), t[:len(t) - half] + u[:half])
        assert 0 <= by[d].near_edited <= 1 and 0 <= by[d].near_next <= 1
    assert by[1].fingerprint == by[2].fingerprint and by[1].near_next == 1
    assert by[4].fingerprint == by[5].fingerprint
    assert len(found) == len(TEXTS)
    assert all(r.edited_sha256 == sha(r.edited) for r in found)
    bare = fingerprints.fingerprint_with_edits(docs, low=0.01, high=0.5, with_text=False)
    assert sorted(map(str, bare.collect())) == sorted(str(r) for r in map(lambda r: type(r)(**{
        c: r[c] for c in bare.columns}), found))
    assert fingerprints.fingerprint_with_edits(empty).count() == 0


def test_token_files(spark, docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    out = scratch(spark, "test-files")
    token_files.write_token_files(docs, out, path, 2)
    got = token_files.read_token_files(spark, out, with_ids=True).orderBy("start").collect()
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for row, (d, text) in zip(got, order, strict=True):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert (row.doc_id, row.start, row.n_tokens, row.ids) == (d, start, len(ids), ids)
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    out = scratch(spark, "test-files")
    token_files.write_token_files(empty, out, path, 2)
    assert token_files.read_token_files(spark, out).count() == 0


def test_word_encoder_letters_are_not_cut():
    """Words of letters alone go to the model as they are; ids equal the tokenizer's, also when the cache is emptied."""
    import regex
    from tokenizers import Tokenizer

    from vantage.llm.unit_cache import UnitCache

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, encoder = Tokenizer.from_file(path), token_files.WordEncoder(path, limit=5)
    cut = []
    encoder.pattern = type("Pattern", (), {"findall": lambda self, text, real=encoder.pattern: cut.append(text) or real.findall(text)})()
    letters = ["Ünïque", "word", "WORD", "e\u0301te\u0301", "\u0130stanbul", "\u00e9", "\u01c5", "\u65e5\u672c", "a" * 300]
    others = ["it's", "'ll", "we've,", "x1y22", "don't!!", "\u00bd", "a\u00a0b", "<|endoftext|>", "\u00ab\u00e7a\u00bb", "a\0b", "$$$"]
    for words in (letters, others, letters + others, others[::-1] + letters, []):
        ids, lens = UnitCache(encoder, 7)([w.encode() for w in words])
        expected = [tokenizer.encode(w, add_special_tokens=False).ids for w in words]
        assert (ids.tolist(), lens.tolist()) == ([i for x in expected for i in x], [len(x) for x in expected])
    assert not any(regex.search(r"(?<!\S)(word|ünïque)(?!\S)", text) for text in cut)


def test_sentencepiece(docs, empty):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    judge = sentencepiece.SentencePieceProcessor(model_file=path)
    got = sentencepiece_bpe.encode_documents(docs, path).collect()
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(d), judge.encode(t or "")) for d, t in TEXTS)
    assert all(r.parity and r.decoded_ok for r in got)
    assert sentencepiece_bpe.encode_documents(empty, path).count() == 0


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_fm.score(docs, quality_fm.quality_model(docs, labels))
    rows = scored.join(labels, "doc_id").where(quality_fm.held_out()).select("score", "quality").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([g >= 0.3 for g in good]) > 0.97
    nothing = quality_fm.quality_model(docs, labels.limit(0))
    odd = quality_fm.score(spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string"), nothing).collect()
    assert all(abs(r.score - 0.5) < 0.05 for r in odd)


def test_vector_search(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = vectors.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    odd = spark.createDataFrame([(100000, None), (100100, [0.0] * 64), (100200, [float("nan")] * 64)], "vec_id long, embedding array<float>")
    got = defaultdict(dict)
    for r in vector_search.search(vectors.select("vec_id", "embedding").unionByName(odd), list_rows=16).collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    hits = []
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[i] = np.inf
        best = set(ids[np.lexsort((ids, d))[:10]].tolist())
        own = got[int(ids[i])]
        assert sorted(own) == list(range(1, 11))
        assert all(abs(d[ids == v][0] - s) < 1e-12 for v, s in own.values())
        hits.append(len(best & {v for v, _ in own.values()}) / 10)
    assert np.mean(hits) >= 0.9 and len(got) == len(hits)
    assert vector_search.search(vectors.limit(0)).count() == 0


def brute_force(rows, top=10, every=100):
    """Ids of the nearest of each query by distance and id; of rows sharing an id the nearest counts."""
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    best = {}
    for q in sorted({i for i in ids.tolist() if i % every == 0}):
        d = np.min([((x - x[i]) ** 2).sum(1) for i in np.flatnonzero(ids == q)], axis=0)
        own = {}
        for i, far in zip(ids.tolist(), d.tolist()):
            if i != q:
                own[i] = min(far, own.get(i, np.inf))
        best[q] = [i for _, i in sorted((far, i) for i, far in own.items())[:top]]
    return best


def vectors_found(spark, rows, **options):
    got = defaultdict(list)
    table = spark.createDataFrame([(i, list(map(float, v))) for i, v in rows], "vec_id long, embedding array<double>")
    for r in vector_search.search(table, **options).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    return got


@pytest.mark.parametrize("list_rows", [2, 8])
def test_vector_search_many_lists_and_equal_vectors(spark, list_rows):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1800, 8))
    x[rng.permutation(1800)[:600]] = x[0]  # id 0 is a query of the group
    best = brute_force(list(enumerate(x)), every=25)
    got = vectors_found(spark, enumerate(x), every=25, list_rows=list_rows)
    assert got.keys() == best.keys() and all(len(own) == 10 for own in got.values())
    assert all(got[q] == best[q] for q in best if (x[q] == x[0]).all())
    assert np.mean([len(set(got[q]) & set(best[q])) / 10 for q in best]) >= 0.9


@pytest.mark.parametrize("block_rows", [64, 4096])
def test_vector_search_repeated_ids(spark, block_rows):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4) + 5) for i in range(100)]
    rows[0] = (0, np.full(4, 5.0))
    rows += [(7, np.full(4, 5.0) + rng.normal(size=4) * 1e-3) for _ in range(60)]  # one id fills the query's list
    rows += [(9, np.full(4, 5.01))] * 30
    for list_rows in (8, 1000):
        got = vectors_found(spark, rows, list_rows=list_rows, block_rows=block_rows)
        assert len(got[0]) == 10 and got[0][:2] == [7, 9]
        if list_rows == 1000:
            assert got == brute_force(rows)


def test_mixing_meets_targets(spark, docs, empty):
    source = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labelled = source.select("doc_id", F.col("lang").alias("domain"))
    targets = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
    rows = mixing.mix(source, labelled, targets).collect()
    total = sum(r.tokens for r in rows)
    for d, share in targets.items():
        assert abs(sum(r.tokens * r.rate * r[f"p_{d}"] for r in rows) - share * total) < 1e-4 * total
    assert all(r.rate >= 0 for r in rows) and len(rows) == source.count()
    covered = mixing.mix(source, labelled, targets, budget="cover")
    assert covered.agg(F.min("rate")).first()[0] > 0.999
    assert mixing.resample(source, covered).select("doc_id").distinct().count() == source.count()
    assert mixing.mix(docs, labelled, targets).count() == len(TEXTS)
    assert mixing.mix(empty, labelled, targets).count() == 0


def test_mixing_cover_drops_none_of_soft_documents(spark):
    soft = [(1.0, 0.0), (0.9, 0.1), (0.2, 0.8), (0.02, 0.98)] * 50
    source = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    odds = spark.createDataFrame([(i, 10 + i % 7, *p) for i, p in enumerate(soft)], "doc_id long, tokens long, p0 double, p1 double")
    table = source.select("doc_id", F.xxhash64("text").alias("body")).join(odds, "doc_id")
    rates = mixing.fit_rates(table, [0.2, 0.8], "cover")
    rows = rates.collect()
    mass = [sum(r.tokens * r.rate * r[p] for r in rows) for p in ("p0", "p1")]
    assert min(r.rate for r in rows) >= 1
    assert abs(mass[0] / sum(mass) - 0.2) < 1e-3
    assert mixing.resample(source, rates).select("doc_id").distinct().count() == 200
    same = mixing.fit_rates(table.withColumns({"p0": F.lit(0.5), "p1": F.lit(0.5)}), [0.9, 0.1], "cover").agg(
        F.min("rate"), F.max("rate")).first()  # no rates meet this
    assert same[0] >= 1 and same[1] < 20
