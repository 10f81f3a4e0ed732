"""Operators whose queries no SQL states, against plain statements of what they compute; and the pipeline stage by stage."""

import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_operators import TEXTS, components
from vantage.llm import fingerprints, jaccard_join, mixing, quality_fm, sentencepiece_bpe, vector_search


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def xx(data, seed=42):
    return signed(xxhash.xxh64_intdigest(data, seed & (1 << 64) - 1))


@pytest.fixture(scope="module")
def source(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


# -- op1 ------------------------------------------------------------------------------------------------

def test_posteriors_and_rates(spark, source):
    """Naive Bayes and projected gradient, written out in numpy."""
    domains, buckets = ["de", "en", "es", "fr"], 1 << 15
    targets = {"en": 0.4, "de": 0.2, "fr": 0.3, "es": 0.1}
    labelled = source.where("doc_id % 3 = 0").select("doc_id", F.col("lang").alias("domain"))
    rows = sorted(source.collect(), key=lambda r: r.doc_id)
    words = [[w for w in (r.text or "").lower().replace("\n", " ").split(" ") if w] for r in rows]
    at = [[xx(w.encode()) % buckets for w in own] for own in words]
    counts, seen = np.zeros((4, buckets)), np.zeros(4)
    for r, own in zip(rows, at):
        if r.doc_id % 3 == 0:
            seen[domains.index(r.lang)] += 1
            np.add.at(counts[domains.index(r.lang)], own, 1)
    like = np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * buckets))
    logit = np.array([like[:, own].sum(1) + np.log((seen + 1) / (seen.sum() + 4)) for own in at])
    p = np.exp(logit - logit.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    got = {r.doc_id: r for r in mixing.mix(source, labelled, targets).collect()}
    tokens = np.array([len(w) for w in words], float)
    for r, own, n in zip(rows, p, tokens):
        assert got[r.doc_id].tokens == n
        assert np.allclose([got[r.doc_id][f"p_{d}"] for d in domains], own, atol=1e-9)
    rate, have = np.ones(len(rows)), tokens @ p
    want = np.array([targets[d] for d in domains]) * tokens.sum()
    for _ in range(60):
        gap = (tokens * rate) @ p - want
        if np.abs(gap).max() <= 1e-6 * tokens.sum():
            break
        rate = np.maximum(0, rate - p @ (gap / have))
    assert np.allclose([got[r.doc_id].rate for r in rows], rate, atol=1e-6)
    assert np.abs((tokens * rate) @ p - want).max() <= 1e-6 * tokens.sum()


# -- op3 ------------------------------------------------------------------------------------------------

def brute_marks(texts, low, high):
    """A function from a text to its signatures: per subset of the lexicon the XOR of its terms' hash halves."""
    def terms(text):
        return {xx(w.encode()) for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w}
    often = Counter(t for text in texts for t in terms(text))
    known = {t for t, n in often.items() if low * len(texts) <= n <= high * len(texts)}
    kinds = [one_in for one_in, times in fingerprints.SUBSETS for _ in range(times)]

    def member(term, bit, one_in):
        return xx(struct.pack("<i", bit), xx(struct.pack("<q", term))) % one_in == 0

    def marks(text):
        own = terms(text)
        base = own & known or own
        out = [frozenset(base)]
        for bit, one_in in enumerate(kinds):
            part = frozenset(t for t in own & known if member(t, bit, one_in))
            out.append(part or None)
        return out
    return marks


def test_signatures_from_sets(spark):
    """Signatures are equal where the term sets of the subset are, and only there."""
    base = [f"word{i % 37} term{i} x{i % 11}" for i in range(400)]
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(base[a:a + int(rng.integers(1, 80))])) for i, a in enumerate(rng.integers(0, 300, 30).tolist())]
    rows += [(30, rows[3][1]), (31, None), (32, ""), (33, "!!"), (34, "Ünï cöde 42")]
    texts = [t or "" for _, t in rows]
    marks = brute_marks(texts, 0.05, 0.6)

    def like(a, b):
        pairs = [(x, y) for x, y in zip(marks(a), marks(b)) if x is not None or y is not None]
        return sum(x == y for x, y in pairs) / len(pairs)
    got = {r.doc_id: r for r in fingerprints.fingerprint_with_edits(
        spark.createDataFrame(rows, "doc_id long, text string"), 0.05, 0.6).collect()}
    for i, text in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert got[i].edited == edited
        assert got[i].near_edited == pytest.approx(like(text, edited)) and got[i].near_next == pytest.approx(like(text, following))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (got[i].fingerprint == got[j].fingerprint) == (marks(a) == marks(b))


def test_fingerprints_of_repeated_rows(spark):
    rows = [(1, "same text"), (1, "same text"), (2, "other text"), (None, "same text"), (None, "same text"), (1, "third")] + [(7, "hot")] * 50
    got = fingerprints.fingerprint_with_edits(spark.createDataFrame(rows, "doc_id long, text string"), 0.0, 1.0)
    found = got.collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in found) == sorted((str(d), len(t)) for d, t in rows)
    assert len({r.fingerprint for r in found if r.n_chars == 9}) == 1
    assert len({tuple(r) for r in found if r.doc_id == 7}) == 1


# -- op4 ------------------------------------------------------------------------------------------------

def test_sum_of_squares_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    model = quality_fm.FactorisationMachine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    lens = np.array([1, 7, 20])
    ids, values = rng.integers(0, 50, 28), rng.normal(size=28)
    for k, (b, n) in enumerate(zip(np.cumsum(lens), lens)):
        i, x = ids[b - n:b], values[b - n:b]
        want = model.bias + sum(model.weight[i] * x) + sum(
            float(model.factor[i[s]] @ model.factor[i[t]]) * x[s] * x[t] for s in range(n) for t in range(s + 1, n))
        assert model.logits(ids, values, lens)[k] == pytest.approx(want)


def test_training_takes_one_row_of_an_id(spark):
    docs = spark.range(3000).selectExpr("7L AS doc_id", "concat('text ', id % 5) AS text").unionByName(
        spark.createDataFrame([(8, "other words"), (9, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(7, 1), (8, 0), (9, 1), (None, 1), (10, None)], "doc_id long, label int")
    seen = []
    fit = quality_fm.fit
    try:
        quality_fm.fit = lambda ids, values, lens, y, **kw: seen.append(len(lens)) or fit(ids, values, lens, y, **kw)
        model = quality_fm.train(docs, labels)
    finally:
        quality_fm.fit = fit
    assert seen == [3]
    clash = docs.withColumns({"score": F.lit("mine"), "predicted": F.lit("mine")})
    out = quality_fm.score(clash.limit(5), model)
    assert dict(out.dtypes)["score"] == "double" and dict(out.dtypes)["predicted"] == "int" and out.count() == 5
    assert quality_fm.score(docs.limit(0), model).count() == 0


# -- op9 ------------------------------------------------------------------------------------------------

def message(*fields):
    """A protobuf message of (number, value) fields: bytes, text, floats and integers."""
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])
    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            value = value.encode() if isinstance(value, str) else value
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def unigram_model(dummy_prefix, drop_blanks):
    words = ["▁", "a", "b", "c", "▁a", "ab", "bc", "abc", "▁abc", "é", "▁b", "ca"]
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(w, -2.0 - 0.37 * i, 1) for i, w in enumerate(words)]
    pieces += [(f"<0x{i:02X}>", -20.0, 6) for i in range(256)]
    return message(*[(1, message((1, p), (2, s), (3, k))) for p, s, k in pieces], (2, message((3, 1), (35, 1))),
                   (3, message((1, "identity"), (3, int(dummy_prefix)), (4, int(drop_blanks)))))


@pytest.mark.parametrize("dummy_prefix,drop_blanks", [(True, False), (True, True), (False, False), (False, True)])
def test_unigram_models(spark, tmp_path, dummy_prefix, drop_blanks):
    """Models that are not plain are judged by whole texts, and the ids are those of the sentencepiece library."""
    import sentencepiece

    path = tmp_path / "model"
    path.write_bytes(unigram_model(dummy_prefix, drop_blanks))
    judge = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["abc abc", "  a  b ", "", None, "bca\ncab", "é ☃ a", "   ", "abcabcabc " * 50, "▁a", "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns(
        {"ids": F.lit("clash"), "parity": F.lit(3)})
    got = sorted(sentencepiece_bpe.encode_documents(docs, str(path)).collect(), key=lambda r: r.doc_id)
    assert [r.ids for r in got] == [judge.encode(t or "") for t in texts]
    assert [r.ids_crc32 for r in got] == [zlib.crc32(np.array(judge.encode(t or ""), "<u4").tobytes()) for t in texts]
    assert all(isinstance(r.parity, bool) for r in got) and got[0].parity
    bare = sentencepiece_bpe.encode_documents(docs, str(path), verify=False).collect()
    assert {r.parity for r in bare} == {None}


# -- the pipeline ---------------------------------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    """Each stage of a run against what it says of its input."""
    import public_tokenizers
    import sentencepiece

    stages = dict(corpus_pipeline.STAGES)
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = given.columns

    def step(name, docs):
        path = str(tmp_path / name)
        stages[name](spark, docs, SF_SMALL).write.parquet(path)
        return spark.read.parquet(path)

    good = step("quality_classifier", given)
    model = quality_fm.quality_model(given, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    keep = {r.doc_id for r in quality_fm.score(given, model).where("predicted = 1").collect()}
    assert good.columns == columns and {r.doc_id for r in good.collect()} == keep and 0 < len(keep) <= given.count()

    lines = step("line_dedup", good)
    owner = {}
    rows = sorted(good.collect(), key=lambda r: r.doc_id)

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for r in rows:
        for line in (r.text or "").split("\n"):
            if len(key(line)) >= 10:
                owner.setdefault(key(line), r.doc_id)
    want = {r.doc_id: "\n".join(x for x in (r.text or "").split("\n") if owner.get(key(x), r.doc_id) == r.doc_id) for r in rows}
    found = lines.collect()
    assert lines.columns == columns and {r.doc_id: r.text for r in found} == want
    assert all(r.n_chars == len(r.text) for r in found)

    single = step("ngram_jaccard_join", lines)
    rows = [(r.doc_id, r.text) for r in found]
    keep = {int(d) for d, n, c in components(rows) if n == 0 or c == int(d)}
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted(keep)

    mixed = step("mixing", single)
    assert mixed.columns == columns
    assert {r.doc_id for r in mixed.collect()} == keep

    ids = step("sentencepiece", mixed)
    judge = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted((r.doc_id, r.ids) for r in ids.collect()) == sorted((r.doc_id, judge.encode(r.text)) for r in mixed.collect())


def test_pipeline_keeps_one_row_of_a_group(spark):
    """Equal rows, equal ids of different texts, and null ids: one row of each group, and all that link with nothing."""
    near = TEXTS[0][1]
    rows = TEXTS + [(None, near), (None, near + " more"), (None, None), (1, near), (1, "five quite other words here now"), (13, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF_SMALL).collect()]
    links = jaccard_join.link_components(docs, with_rows=True).collect()
    groups = {r.group_id for r in links if r.group_id is not None}
    alone = sum(r.group_id is None for r in links)
    assert len(got) == len(groups) + alone
    assert got.count((1, near)) == 1 and (2, near) not in got and (None, near) not in got
    assert (1, "five quite other words here now") in got
    assert sum(not (t or "").strip() for _, t in got) == sum(not (t or "").strip() for _, t in rows)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), SF_SMALL).count() == 0


# -- op6 ------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("kind", ["normal", "uniform", "skewed"])
def test_vector_search_without_clusters(spark, kind):
    """Rows that fall into no lists: every true neighbour is found, in order."""
    rng = np.random.default_rng(8)
    x = {"normal": rng.normal(size=(6000, 32)), "uniform": rng.random((6000, 32)),
         "skewed": rng.normal(size=(6000, 32)) * rng.lognormal(0, 2, (6000, 1)) + 50}[kind]
    table = spark.createDataFrame([(i, row) for i, row in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {}
    for r in vector_search.search(table).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 6000, 100))
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        want = [i for i in np.lexsort((np.arange(len(x)), d)) if i != q][:10]
        assert [i for i, _ in found] == want
        assert np.allclose([s for _, s in found], d[want], rtol=1e-12)


def test_vector_search_chunks_of_queries(spark, monkeypatch):
    """Queries that go to the tasks in several chunks give the same rows."""
    rng = np.random.default_rng(9)
    table = spark.createDataFrame([(i, row) for i, row in enumerate(rng.normal(size=(1500, 16)).tolist())],
                                  "vec_id long, embedding array<double>")
    want = sorted(map(tuple, vector_search.search(table, every=10, block_rows=64).collect()))
    plain = vector_search.checked
    monkeypatch.setattr(vector_search, "checked", lambda *args: plain(*args, chunk_values=400, tile=7))
    assert sorted(map(tuple, vector_search.search(table, every=10, block_rows=64).collect())) == want
