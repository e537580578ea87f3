"""Phrase counts, whitening and byte pairs against brute force and the library."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from contestlab.llm import byte_pairs, phrases, whitening
from contestlab.llm.token_counts import vocabulary_path

RANKS = vocabulary_path(byte_pairs.RANKS)
PATTERN = byte_pairs.vocabulary_pattern()
SCHEMA = "doc_id bigint, text string, lang string, rank string, Ids string"


def docs_of(spark, rows):
    """Documents with more columns, whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


# Phrases


def corpus():
    rng = random.Random(2)
    words = ["Aa", "b", "cc", "é", "ÉÀ", "z-z", "\xa0", "w'w"]
    rows = []
    for i in range(60):
        body = []
        for _ in range(rng.randrange(60)):
            body.append(rng.choice(words))
            body.append(rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "\x0b", " ; "]))
        rows.append((i, "".join(body), rng.choice(["en", "en", "fr", None])))
    rows += [(100, None, "en"), (101, "", None), (102, " .,;\t\r\n", "xx"), (103, "new york " * 40, "und")]
    rows += [(104, "new york city " * 3000, "de"), (105, "a b c a b c", "de"), (None, rows[1][1], "en")]
    return [*rows, rows[0], rows[0]]


def plain_collocations(rows, least, kept):
    counts, totals = Counter(), Counter()
    lower = {i: i + 32 for i in range(65, 91)}
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i : i + n])] += 1
    found = {}
    for (lang, p), a in counts.items():
        if len(p) > 1 and a >= least:
            cuts = []
            for k in range(1, len(p)):
                left, right = counts[lang, p[:k]], counts[lang, p[k:]]
                cuts.append((2000000 * a // (left + right), k, left, right))
            found[lang, p] = (a, *min(cuts))
    out = []
    for lang in {key[0] for key in found}:
        rows = []
        for (own, p), (a, score, _, left, right) in found.items():
            inside = any(
                o == lang and len(q) > len(p) and 100 * b[0] >= 80 * a
                and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for (o, q), b in found.items()
            )
            if own == lang and not inside:
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:kept], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("least, kept", [(3, 2000), (30, 2000), (4, 5)])
def test_collocations_equal_brute_force(spark, least, kept):
    rows = corpus()
    found = phrases.collocations(docs_of(spark, rows).repartition(5), least=least, kept=kept)
    assert sorted(map(tuple, found.collect())) == plain_collocations(rows, least, kept)


def test_a_trie_that_bursts_and_spills_counts_alike(spark):
    """Small chunks, containers, tries and dictionaries give the same counts."""
    docs = docs_of(spark, corpus())
    texts = phrases.texts_of(docs, "text", "lang")

    def counted(**small):
        words = phrases.word_runs(texts, small.get("held", 1000)).groupBy("lang", "phrase").sum("f")
        known = phrases.frequent_words(words, 12)
        pairs = phrases.frequent_pairs(phrases.phrase_runs(texts, known, None, 12, **small), 1, 12)
        long = phrases.phrase_runs(texts, known, pairs, 12, **small)
        return {tuple(r) for r in phrases.merged(long, 1).collect()}

    small = counted(entries=20, held=7, chunk=16)
    assert small == counted() and len(small) > 300


def test_triples_by_code_lose_no_frequent_phrase(spark):
    """Whatever the chunks, runs and dictionaries, and however many triples share a bit."""
    texts = phrases.texts_of(docs_of(spark, corpus()), "text", "lang")
    words = phrases.word_runs(texts).groupBy("lang", "phrase").sum("f")
    known = phrases.frequent_words(words, 12)

    def counted(least, **small):
        pairs = phrases.frequent_pairs(phrases.code_runs(texts, known, (), 12, **small), least, 12)
        runs = phrases.code_runs(texts, known, (pairs,), 12, **small)
        triples = phrases.frequent_pairs(runs, least, 12)
        long = phrases.phrase_runs(texts, known, pairs, 12, triples=triples, **small)
        return {tuple(r) for r in phrases.merged(long, least).collect()}

    pairs = phrases.frequent_pairs(phrases.code_runs(texts, known, (), 12), 1, 12)
    plain = phrases.phrase_runs(texts, known, pairs, 12)
    every = {tuple(r) for r in phrases.merged(plain, 1).collect()}
    for least in (1, 6, 30):
        often = {r for r in every if r[2] >= least}
        assert counted(least) == often
        assert counted(least, entries=20, held=7, chunk=16) == often


def test_trie_bursts_and_keeps_counts():
    trie = phrases.HatTrie(burst=3)
    rng = np.random.default_rng(0)
    first, second = rng.integers(1, 4, 500), rng.integers(1, 9, 500)
    for at in range(0, 500, 50):
        trie.add(first[at : at + 50], second[at : at + 50].astype(np.int64) << 42)
    assert trie.nodes and trie.entries == len(set(zip(first.tolist(), second.tolist())))
    parts = [trie.spill(trie.entries // 2), trie.spill(0)]
    assert trie.entries == 0 and not trie.root and len(parts[0][0])
    got = Counter()
    for words, rest, counts in parts:
        for w, r, n in zip(words.tolist(), rest.tolist(), counts.tolist()):
            got[w, r >> 42] += n
    assert got == Counter(zip(first.tolist(), second.tolist()))


def test_runs_are_sorted_and_a_rare_word_ends_a_phrase():
    words = [b"", b"b", b"a", b"c"]
    spilled = np.array([1, 2, 2]), np.array([2 << 42, 3 << 42, 1 << 42 | 3 << 21]), np.array([5, 1, 2])
    (run,) = phrases.sorted_run("en", words, spilled)
    assert run.column("phrase").to_pylist() == ["a b c", "a c", "b a"]
    assert run.column("f").to_pylist() == [2, 1, 5]
    ids = np.array([1, 2, 0, 3, 1, 2, 3])
    joined = (ids[:-1] > 0) & (ids[1:] > 0)
    assert phrases.starts_of(joined, 2, 0).tolist() == [0, 3, 4, 5]
    assert phrases.starts_of(joined, 3, 5).tolist() == [3, 4]  # that end behind five ids
    assert phrases.starts_of(joined[:1], 3, 0).tolist() == []


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_words_and_signs_of_all_characters(chunk):
    rng = random.Random(5)
    signs = [*map(chr, range(256)), "\u2028", "\u3000", "😀", *" \t.,;:!?\n\r" * 6]
    text = "".join(rng.choice(signs) for _ in range(20000))
    lower = {i: i + 32 for i in range(65, 91)}
    plain = re.findall("[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]", text.translate(lower))
    plain = ["." if re.fullmatch("[.,;:!?\n-\r]", w) else w for w in plain]
    found = [w for part in phrases.tokens(text.encode(), chunk) for w in part]
    assert [w.decode() for w in found] == plain


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3 * 10**14
    rows = [("en", "x", 1, big + 1), ("en", "y", 1, big), ("en", "x y", 2, big)]
    out = phrases.scored(spark.createDataFrame(rows, "lang string, phrase string, size int, f bigint"))
    assert [r["score"] for r in out.collect()] == [2000000 * big // (2 * big + 1)]


def test_no_texts_no_collocations(spark):
    assert phrases.collocations(docs_of(spark, [])).count() == 0
    assert phrases.collocations(docs_of(spark, [(1, None, None), (2, "", "en")])).count() == 0


# Whitening


def vectors_of(spark, rows):
    schema = "vec_id bigint, embedding array<float>, n string, component string"
    return spark.createDataFrame([(*r, "x", "y") for r in rows], schema)


def planted(n=300, d=40, seed=0):
    rng = np.random.default_rng(seed)
    values = (rng.normal(size=(n, d)) * np.exp(rng.normal(size=d)) + 5).astype(np.float32)
    return [(i, v.tolist()) for i, v in enumerate(values)]


def plain_whitening(rows, components=32):
    x = np.floor(64 * np.array([v for _, v in rows], np.float64)).astype(np.int64) + 1_000_000
    n = len(x)
    scaled = n * x - x.sum(axis=0)
    covariance = (scaled / n).T @ (scaled / n) / n
    values, parts = np.linalg.eigh(covariance)
    values, parts = values[::-1][:components], parts[:, ::-1][:, :components]
    return scaled / n @ parts / np.sqrt(values), values / np.trace(covariance), (scaled**2).sum(axis=1)


def test_whitening_equals_the_eigenvectors_of_the_covariance(spark):
    rows = planted()
    odd = [(900, None), (901, []), (902, [1.0] * 39 + [None]), (903, [float("nan")] * 40)]
    odd += [(904, [float("inf")] + [0.0] * 39)]
    out = whitening.whitened(vectors_of(spark, rows + odd).repartition(4)).collect()
    assert len(out) == 300 * 32 and {r["n"] for r in out} == {300}
    want, explained, deviation = plain_whitening(rows)
    got = np.zeros_like(want)
    for r in out:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert int(r["deviation"]) == int(deviation[r["vec_id"]])
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got * signs - want).max() < 1e-8
    error = np.abs(got.T @ got / 300 - np.eye(32)).max()
    assert {r["identity_error"] for r in out} == {out[0]["identity_error"]}
    assert out[0]["identity_error"] < 1e-9 and error < 1e-9


def test_rank_and_several_lengths(spark):
    """Fewer components than dimensions, vectors of several lengths, repeated
    and null ids, and lengths whose vectors do not differ."""
    rng = np.random.default_rng(3)
    base = rng.integers(-50, 50, (20, 3)) @ rng.integers(-3, 3, (3, 10))
    long = [(i, (v / 64).tolist()) for i, v in enumerate(base)]
    short = [(i, [float(i % 7), 1.0]) for i in range(30)] + [(None, [2.5, 1.0]), (3, [3.0, 1.0])]
    single = [(77, [1.0] * 5), (78, [2.0] * 6), (79, [2.0] * 6)]
    out = whitening.whitened(vectors_of(spark, long + short + single)).collect()
    by_n = Counter(r["n"] for r in out)
    assert by_n == {20: 20 * 3, 32: 32}
    assert max(r["identity_error"] for r in out) < 1e-9
    assert sum(r["vec_id"] is None for r in out) == 1 and sum(r["vec_id"] == 3 and r["n"] == 32 for r in out) == 2
    assert {round(r["explained"], 9) for r in out if r["n"] == 32} == {1.0}
    assert whitening.whitened(vectors_of(spark, [])).count() == 0
    assert whitening.whitened(vectors_of(spark, single)).count() == 0


def test_numbers_beyond_64_bits(spark):
    """Sums, deviations and entries that no 64-bit number holds."""
    x = np.array([[2**61, 1], [-(2**61), 3]])
    assert whitening.exact_sum(np.concatenate([x, x, x[:1]])).tolist() == [2**61, 9]
    centre = whitening.Centre.of(2, [1, 4])
    assert centre.deviations(x) == [(2**62 - 1) ** 2 + 4, (2**62 + 1) ** 2 + 4]
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])]
    out = whitening.whitened(vectors_of(spark, rows)).collect()
    # Beside such entries the other dimension is rounding: one component.
    assert len(out) == 3 and {r["n"] for r in out} == {3}


@pytest.mark.parametrize("n, d", [(500, 1), (500, 7), (80, 33), (20, 30)])
def test_cholesky_and_rotations(n, d):
    x = np.random.default_rng(d).normal(size=(n, d)) * np.exp(np.linspace(-6, 6, d))
    a = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    factor, order = whitening.pivoted_cholesky(a)
    assert factor.shape[1] == min(d, n - 1)
    assert np.allclose(factor @ factor.T, a[np.ix_(order, order)], rtol=1e-10, atol=1e-9 * a.max())
    assert np.allclose(factor, np.tril(factor)) and (np.diff(np.diag(factor)) <= 1e-12).all()
    values, parts = whitening.eigen(a)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][: len(values)], rtol=1e-6)
    assert np.allclose(parts.T @ parts, np.eye(len(values)), atol=1e-12)
    assert np.allclose(a @ parts, parts * values, atol=1e-12 * values[0])


# Byte pairs

ODD = [
    None,
    "",
    " ",
    "a  b \n c\t\td  ",
    "<|endoftext|> don't WE'LL 'sabc ''s x's'",
    "  1234 ***é漢字\U0001f600 ▁x\x1c\x85　 y",
    "long words " * 20000,
    "x" * 200_000 + "1" * 100_000,
    "a" + " " * 70_000 + "b" + "\n \t" * 40_000,
    "　" * 66_000,
    "é" * 150_000,
]


@pytest.fixture(scope="module")
def codec():
    return byte_pairs.Codec(RANKS, PATTERN)


def test_ids_are_the_library_s_and_decode_to_the_text(spark, codec):
    rows = [(i, t, None) for i, t in enumerate(ODD)] + [(3, ODD[3], "x"), (None, "null id", None)]
    docs = docs_of(spark, rows)
    out = byte_pairs.encoded(docs, RANKS, PATTERN, batch_bytes=1000)
    assert out.columns == [*docs.columns, "n_tokens", "_ids"]
    back = byte_pairs.decoded(out, RANKS, PATTERN, "_ids").collect()
    assert len(back) == len(rows)
    for r in back:
        text = r["text"] or ""
        want = codec.encoding.encode_ordinary(text)
        assert byte_pairs.id_list(r["_ids"]) == want and r["n_tokens"] == len(want)
        assert bytes(r["decoded"]) == text.encode()
    assert byte_pairs.encoded(docs_of(spark, []), RANKS, PATTERN).count() == 0


def test_cut_texts_have_the_same_ids(codec):
    rng = random.Random(1)
    signs = "abS'sltredm019 \t\n\r.,!-é中　́\x1c\x00\xa0'"
    for _ in range(1500):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(60)))
        for chars in (1, 2, 5):
            parts = [p for p, _ in byte_pairs.segments(text, chars)]
            assert "".join(parts) == text
            ids = [i for p in parts for i in codec.encoding.encode_ordinary(p)]
            assert ids == codec.encoding.encode_ordinary(text)
    longest = max(len(p) for p, _ in byte_pairs.segments(ODD[6]))
    assert longest <= byte_pairs.SEGMENT_CHARS + 10


def test_white_space_that_the_library_cannot_match(codec):
    text = "x" + " " * 3_000_000 + "y"
    ids = codec.encode(text)
    assert codec.decode(ids) == text.encode()
    # As with a run that the library still matches, a space goes with the word behind.
    assert ids[-1:].tolist() == codec.encoding.encode_ordinary("x   y")[-1:]


def test_decoding_raw_bytes(spark, codec):
    """Ids that end inside a character, null, and ids without a token."""
    ids = codec.encode("\U0001f600")
    rows = [(1, ids[:1].tobytes()), (2, None), (3, b"")]
    df = spark.createDataFrame(rows, "k int, ids binary")
    out = {r["k"]: r["decoded"] for r in byte_pairs.decoded(df, RANKS, PATTERN).collect()}
    assert bytes(out[1]) == "\U0001f600".encode()[: len(out[1])] and 0 < len(out[1]) < 4
    assert out[2] is None and bytes(out[3]) == b""
    with pytest.raises(ValueError):
        codec.decode(np.array([10**6], "<u4"))


def test_digests_of_the_query(spark, codec, tmp_path):
    from contestlab.llm.queries import QUERIES

    rows = [(i, t, None) for i, t in enumerate(ODD)]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    for r in QUERIES["op13_byte_pairs"](spark, str(tmp_path)).collect():
        text = ODD[r["doc_id"]] or ""
        ids = codec.encoding.encode_ordinary(text)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert r["ids_sha256"] == hashlib.sha256(packed).hexdigest() and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_code_blocks_are_small_and_whole():
    rng = np.random.default_rng(2)
    odd = np.array([0, 0, 1, 127, 128, (1 << 40) - 1, (1 << 40) - 1], np.int64)
    runs = [odd, rng.integers(0, 1 << 40, 200_000), np.zeros(0, np.int64), np.full(1000, 77)]
    runs += [odd, np.repeat(rng.integers(0, 1 << 20, 500), 40)]
    for part_bits in (6, 11):
        batches = [b for codes in runs for b in phrases.code_blocks(codes, part_bits)]
        table = pa.Table.from_batches(batches)
        got = {1: [], 4: [], 1000: []}
        for part in set(table.column("part").to_pylist()):
            own = table.filter(pc.equal(table.column("part"), part))
            for least in got:
                got[least] += phrases.summed_codes(own, least).tolist()
        codes, n = np.unique(np.concatenate(runs), return_counts=True)
        for least, found in got.items():
            assert sorted(found) == codes[n >= least].tolist()
    (*_, big) = phrases.varints(np.diff(np.unique(runs[1])))
    assert big[-1] < 5 * 200_000  # a code and its count took 16 bytes
    assert list(phrases.code_blocks(np.zeros(0, np.int64), 6)) == []
