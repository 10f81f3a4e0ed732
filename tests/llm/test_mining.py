"""Phrase mining, SimHash links and spelling variants against brute-force statements of their contracts."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vantage.llm import collocations, count_transducer, simhash_dedup, spelling_variants
from vantage.llm.queries import QUERIES
from vantage.llm.word_automata import Acceptor

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [
    (1, "The Same words. again, the same words; the same", "en"), (2, None, "en"), (3, "", None), (4, "  \t ", "en"),
    (5, "The Same words. again, the same words; the same", "en"), (5, "other row of five", "de"), (None, "the same words", None),
    (None, None, None), (7, "Ünïcode wörter sind wörter\x0bwörter sind", "de"), (8, "colour color colors colorr couleur", "en"),
    (9, "x" * 2000 + " " + "y" * 1999 + " " + "x" * 1999, "en"), (10, "one", "en"), (11, "a  b\tc d e f g", None),
    (12, "odd lang odd lang odd lang", "x\ty\nz"),
]


@pytest.fixture(scope="module")
def rows(spark):
    real = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    return ODD * 3 + real


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.withColumns({"n": F.lit("clash"), "a": F.lit(1), "word": F.lit("x"), "fp": F.lit(0), "chunk": F.lit(2)}).repartition(5)


def brute_phrases(rows, least, percent, top):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i:i + size])] += 1
    out = []
    for lang, count in counts.items():
        able = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        gone = {p[i:j] for p, a in able.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and 100 * a >= percent * count[p[i:j]]}
        ranked = []
        for p, a in able.items():
            if p not in gone:
                score, k = min((1000 * a * total[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


@pytest.mark.parametrize("least,percent,top", [(3, 100, 50), (2, 60, 100_000)])
def test_collocations(docs, rows, least, percent, top):
    got = collocations.top_phrases(docs, least=least, percent=percent, top=top, shard_bytes=50_000, bucket_words=3000,
                                  range_arcs=700, sample_every=4)
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "bigint", "string"] + ["bigint"] * 5
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, least, percent, top)


def test_collocations_exact_beyond_64_bits(spark):
    """A score's products pass 64 bits; the quotient is exact."""
    a, n, left, right = 4_000_000_000_007, 9_000_000_000_011, 4_000_000_000_009, 5_000_000_000_021
    phrase = spark.createDataFrame([(1, 0, 0, 0, "en", a, [left, a], [right, a])],
                                   "id long, start long, back long, word long, lang string, a long, heads array<long>, tails array<long>")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    assert collocations._scored(phrase, None, 100, totals).first().score == 1000 * a * n // (left * right)


def test_count_transducer_layers():
    """Cut into prefix ranges and united again, shards' layers are the layer of all n-grams."""
    rng = np.random.default_rng(1)
    shards = [(rng.integers(0, 9, 400), rng.integers(0, 7, 400)) for _ in range(3)]
    layers = [count_transducer.build(count_transducer.pack(s, w), 10 * s)[:3] for s, w in shards]
    bounds = np.sort(count_transducer.pack(np.array([2, 5]), np.array([3, 0])))
    got = []
    for i in range(3):
        parts = []
        for arcs, weights, back in layers:
            cuts = count_transducer.cut(arcs, bounds)
            parts.append(tuple(x[cuts[i]:cuts[i + 1]] for x in (arcs, weights, back)))
        arcs, weights, back = count_transducer.union(parts, 15)
        assert (back == 10 * count_transducer.start_of(arcs)).all()
        got += zip(count_transducer.start_of(arcs).tolist(), count_transducer.word_of(arcs).tolist(), weights.tolist())
    want = Counter((int(a), int(b)) for s, w in shards for a, b in zip(s, w))
    assert got == sorted((*k, n) for k, n in want.items() if n >= 15)


def brute_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items, near):
    """Smallest non-null id reachable for each (id, value), values linked where ``near``."""
    values = sorted({v for _, v in items})
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    for i, v in enumerate(values):
        for w in values[i + 1:]:
            if near(v, w):
                root[find(w)] = find(v)
    low = {}
    for d, v in items:
        if d is not None:
            low[find(v)] = min(d, low.get(find(v), d))
    return [low.get(find(v)) for _, v in items]


def test_simhash_links(docs, rows):
    prints = [(d, brute_fingerprint(t)) for d, t, _ in rows]
    comps = brute_components(prints, lambda v, w: bin(v ^ w).count("1") <= 4)
    want = sorted((str(d), f"{v:016x}", str(c)) for (d, v), c in zip(prints, comps))
    for segments in (None, 2, 4, 5):
        got = simhash_dedup.link_components(docs, segments=segments, block_rows=3, pack_rows=50)
        assert got.columns == ["doc_id", "fingerprint", "component_id"]
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got.collect()) == want


def test_simhash_slices_and_spark_hash(spark):
    text = "Ein LANGER text mit vielen wörtern " * 400
    whole = simhash_dedup.simhash(text.encode().lower(), 4)
    assert simhash_dedup.simhash(text.encode().lower(), 4, step=37) == whole == brute_fingerprint(text)
    one = spark.sql("SELECT xxhash64('a b c wörter') AS h").first().h % 2**64
    assert list(simhash_dedup.shingle_hashes("a b c wörter".encode(), 4))[0].tolist() == [one]


def test_simhash_segments_cover():
    """Whatever bits differ, some segment is within its radius."""
    rng = np.random.default_rng(2)
    for distance, segments in ((4, 2), (4, 3), (4, 4), (4, 5), (3, 2), (0, 3)):
        plan = simhash_dedup.segment_plan(distance, segments)
        assert sum(width for _, width, _ in plan) == 64
        for _ in range(500):
            x = sum(1 << int(b) for b in rng.choice(64, distance, replace=False))
            assert any(bin(x >> low & (1 << width) - 1).count("1") <= radius for low, width, radius in plan)


def test_simhash_dense_group(spark, monkeypatch):
    """A chain of fingerprints, each near the next only, and many values in one table entry."""
    chain = [sum(1 << b for b in range(3 * i)) for i in range(1, 20)]
    close = [0xFFFF_0000_0000_0000 | 1 << a | 1 << b for a in range(20) for b in range(a)]
    items = list(enumerate(chain + close))
    frame = spark.createDataFrame([(d, v - (1 << 64) if v >> 63 else v) for d, v in items], "doc_id long, fp long")
    monkeypatch.setattr(simhash_dedup, "fingerprints", lambda docs, size: docs)
    want = dict(zip([d for d, _ in items], brute_components(items, lambda v, w: bin(v ^ w).count("1") <= 4)))
    for segments, block in ((3, 5), (2, 4096)):
        got = simhash_dedup.link_components(frame, segments=segments, block_rows=block)
        assert {r.doc_id: r.component_id for r in got.collect()} == want


def near_words(words):
    by_hole = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by_hole[i, w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)
    for (_, rest), group in by_hole.items():
        for a in group:
            near[a] |= group - {a}
            if rest in words:
                near[a].add(rest)
                near[rest].add(a)
    return near


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=6), max_size=60))
def test_one_edit_composition(words):
    got = list(Acceptor(sorted(words)).one_edit_pairs())
    assert len(got) == len(set(got))
    near = near_words(words)
    assert {frozenset(p) for p in got} == {frozenset((a, b)) for a in near for b in near[a]}


def test_acceptor_is_minimal():
    words = sorted(a + b + "ing" for a in "abcdef" for b in "xyz")
    assert len({(Acceptor(words).final[s], tuple(Acceptor(words).arcs[s].items())) for s in _reached(Acceptor(words))}) \
        == len(_reached(Acceptor(words))) == 6


def _reached(acceptor):
    seen, open_ = {0}, [0]
    while open_:
        for to in acceptor.arcs[open_.pop()].values():
            if to not in seen:
                seen.add(to)
                open_.append(to)
    return seen


def brute_variants(rows, least):
    count = Counter()
    for d, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= least}
    near = near_words(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {(w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


@pytest.mark.parametrize("max_words", [50_000, 4])
def test_spelling_variants(docs, rows, max_words):
    """With small partitions every one of them is cut down to its last letter."""
    got = spelling_variants.variant_groups(docs, max_words=max_words, rows_per_task=500)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == brute_variants(rows, 3)


def test_empty_tables(docs):
    empty = docs.limit(0)
    assert collocations.top_phrases(empty).collect() == []
    assert simhash_dedup.link_components(empty).collect() == []
    assert spelling_variants.variant_groups(empty).collect() == []
    blank = docs.where("text IS NULL").select("doc_id", "text", "lang")
    assert collocations.top_phrases(blank).collect() == []
    assert {r.fingerprint for r in simhash_dedup.link_components(blank).collect()} == {"0" * 16}
    assert spelling_variants.variant_groups(blank).collect() == []


def test_mining_queries(spark):
    """The registered queries with their own parameters over a whole table."""
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op11_collocations"](spark, SF_SMALL).collect()) == brute_phrases(rows, 100, 100, 2000)
    prints = [(d, brute_fingerprint(t)) for d, t, _ in rows]
    comps = brute_components(prints, lambda v, w: bin(v ^ w).count("1") <= 4)
    got = QUERIES["op12_simhash_dedup"](spark, SF_SMALL).collect()
    assert sorted(tuple(r) for r in got) == sorted((d, f"{v:016x}", c) for (d, v), c in zip(prints, comps))
    assert {tuple(r) for r in QUERIES["op13_spelling_variants"](spark, SF_SMALL).collect()} == brute_variants(rows, 3)


def test_acceptor_holds_no_replaced_states():
    """States that were replaced by registered ones are used again: as many are held as the minimal acceptor has, and a path."""
    from vantage.llm.word_automata import Acceptor

    words = sorted({f"{a:03d}ending" for a in range(1000)})
    acceptor = Acceptor(words)
    assert len(acceptor.arcs) <= 1 + 3 + 2 * 9
    assert sum(1 for _ in acceptor.one_edit_pairs()) == 1000 * 27 // 2


def test_units_reach_the_libraries_a_bounded_number_at_a_time(monkeypatch):
    import public_tokenizers

    from vantage.llm import sentencepiece_bpe

    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = [" ".join(f"word{i} zahl{i * 7}" for i in range(a, a + 40)) for a in range(0, 4000, 40)]
    seen = []
    plain = sentencepiece_bpe.Codec._encode_some
    monkeypatch.setattr(sentencepiece_bpe.Codec, "_encode_some", lambda self, units: seen.append(len(units)) or plain(self, units))
    ids, counts, agreed = sentencepiece_bpe.Codec(path).encode(texts)
    assert len(seen) > 1 and max(seen) <= 2048 and agreed.all()
    import sentencepiece

    judge = sentencepiece.SentencePieceProcessor(model_file=path)
    assert ids.tolist() == [i for own in judge.encode(texts) for i in own] and len(counts) == len(texts)


class CountingJudge:
    """The sentencepiece library with the number of texts it got; wrong on texts that hold ``wrong``."""

    def __init__(self, judge, wrong=None):
        self.judge, self.wrong, self.texts = judge, wrong, 0

    def encode(self, given, **options):
        if isinstance(given, str):
            return self.judge.encode(given)
        self.texts += len(given)
        return [own + [5] * bool(self.wrong and self.wrong in t) for t, own in zip(given, self.judge.encode(given, **options))]


def test_units_reach_the_libraries_joined():
    """Distinct units cost no text of their own, unless the libraries differ or a unit has several spaces."""
    import public_tokenizers

    from vantage.llm import sentencepiece_bpe

    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = [" ".join(f"word{i} zahl{i * 7}" for i in range(a, a + 40)) for a in range(0, 4000, 40)]
    codec = sentencepiece_bpe.Codec(path)
    right, codec.judge = codec.judge, CountingJudge(codec.judge)
    ids, counts, agreed = codec.encode(texts)
    assert ids.tolist() == [i for own in right.encode(texts) for i in own] and agreed.all()
    assert codec.judge.texts <= 8000 // 100
    codec = sentencepiece_bpe.Codec(path)
    codec.judge = CountingJudge(codec.judge, "word123")
    ids, counts, agreed = codec.encode(texts)
    assert codec.differing == {"word123", *(f"word{i}" for i in range(1230, 1240))}
    assert [i for i, x in enumerate(agreed) if not x] == [3, 30]
    assert counts.tolist() == [len(own) + (i == 3) + 10 * (i == 30) for i, own in enumerate(right.encode(texts))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "the", "ing", " ", " ", "  ", "▁", "\n", "\t", "é", "☃", "\x00", "\u00a0", "🙂",
                                          "<s>", "<unk>", "<0x0A>", "\ufffd", "1", "'"]), max_size=12).map("".join), max_size=12),
       st.booleans())
def test_encoded_texts_are_those_of_the_library(texts, verify):
    import public_tokenizers

    from vantage.llm import sentencepiece_bpe

    codec = sentencepiece_bpe.worker_codec(public_tokenizers.path("piece_bpe_32k.model"), 1, verify)
    judge = sentencepiece_bpe.worker_codec(public_tokenizers.path("piece_bpe_32k.model"), 1, True).judge
    ids, counts, agreed = codec.encode(texts)
    want = [judge.encode(t) for t in texts]
    assert ids.tolist() == [i for own in want for i in own] and counts.tolist() == [len(own) for own in want] and agreed.all()


@pytest.mark.parametrize("words,fallback", [
    (["▁", "a", "b", "c", "▁a", "ab", "▁ab", "bc", "▁▁"], True), (["▁", "a", "b", "c", "▁a", "ab", "▁ab", "bc", "▁▁"], False),
    (["a", "b", "c", "ab", "bc"], True), (["▁", "a", "b", "c", "▁a", "ab", "a▁b", "b▁", "▁b"], True),
    (["▁", "a", "b", "c", "▁a", "ab", "a▁b", "b▁", "▁b"], False)])
def test_small_bpe_models(tmp_path, words, fallback):
    """Models with and without bytes, without a piece for the mark (it is bytes), and with pieces over several words."""
    import sentencepiece

    from tests.llm.test_brute_force import message
    from vantage.llm import sentencepiece_bpe

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(w, -1.0 - i, 1) for i, w in enumerate(words)]
    pieces += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)] * fallback
    path = tmp_path / "model"
    path.write_bytes(message(*[(1, message((1, p), (2, s), (3, k))) for p, s, k in pieces], (2, message((3, 2), (35, int(fallback)))),
                             (3, message((1, "identity"), (3, 1), (4, 0)))))
    judge = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["abc abc b", "a  b", "", " a b ", "xyz abx x yab c", "   ", "é a", "abcabc " * 300, "a b a b", "x", "a▁b c"]
    ids, counts, agreed = sentencepiece_bpe.Codec(str(path)).encode(texts)
    want = [judge.encode(t) for t in texts]
    assert counts.tolist() == [len(own) for own in want] and ids.tolist() == [i for own in want for i in own]
