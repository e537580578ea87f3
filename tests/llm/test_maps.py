"""Token counts, classifiers and segmentations against plain versions."""

import dataclasses
import itertools
import math
import re
import tracemalloc
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
import pytest

from contestlab.llm import quality, segmentation, toxicity
from contestlab.llm.samples import all_labelled, labelled_sample
from contestlab.llm.segmentation import Sampler, Vocabulary, sampled_encodings
from contestlab.llm.token_counts import Counter, token_counts, vocabulary_path
from contestlab.llm.words import batch_words, shingles

ODD = [
    None,
    "",
    " ",
    "a  b \n c\t\td  ",
    "\n\n x y <|endoftext|> z <|endoftext|>",
    "don't WE'LL  1234 ***é漢字\U0001f600 ▁x",
    "word " * 3000,
    "x" * 5000,
]


def docs_of(spark, texts):
    rows = [(i, t, "s", f"n{i}") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, score string, n_tokens string")


def test_words_are_those_of_the_pattern():
    found = batch_words(pa.array(ODD))
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = {i: i + 32 for i in range(65, 91)}
    plain = [pattern.findall((t or "").translate(lower)) for t in ODD]
    assert np.diff(found.offsets).tolist() == [len(w) for w in plain]
    words = list(itertools.chain(*plain))
    assert len(set(found.hashes.tolist())) == len(set(words))
    assert len(set(zip(words, found.hashes.tolist()))) == len(set(words))
    runs, offsets = shingles(found, 5)
    want = [max(len(w) - 4, min(1, len(w))) for w in plain]
    assert np.diff(offsets).tolist() == want
    assert len(set(runs[offsets[6] : offsets[7]].tolist())) == 1


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary_path())
    out = token_counts(docs_of(spark, ODD), vocabulary_path(), batch_bytes=100)
    assert out.columns[-1] == "_n_tokens" and out.columns[3] == "n_tokens"
    got = {r["doc_id"]: r["_n_tokens"] for r in out.collect()}
    for i, text in enumerate(ODD):
        assert got[i] == len(own.encode(text or "", add_special_tokens=False).ids)
    counter = Counter(vocabulary_path(), cached=2)
    assert counter.counts(["a b c", "a b c"]).tolist() == [3, 3]
    assert token_counts(docs_of(spark, []), vocabulary_path()).count() == 0


def labels_of(spark, docs, column, rule):
    rows = [(r["doc_id"], int(rule(r["text"]))) for r in docs.collect()]
    return spark.createDataFrame(rows, f"doc_id bigint, {column} int")


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("aeioustrn"), 5)) for _ in range(300)]
    texts = []
    for i in range(400):
        body = list(rng.choice(words, rng.integers(20, 80)))
        if i % 4 == 0:
            body[rng.integers(len(body))] = "vile" + str(rng.choice(["ness", "ly", "st"]))
        if i % 5 == 0:
            body = [w + "###" for w in body]
        texts.append(" ".join(body))
    return docs_of(spark, texts)


@pytest.mark.parametrize(
    "module, scores, column, rule",
    [
        (toxicity, toxicity.toxicity_scores, "toxic", lambda t: "vile" in t),
        (quality, quality.quality_scores, "quality", lambda t: "###" not in t),
    ],
)
def test_classifiers_on_held_out_rows(spark, planted, module, scores, column, rule):
    labels = labels_of(spark, planted, column, rule)
    out = scores(planted, labels).collect()
    assert set(out[0].asDict()) == {"doc_id", "text", "score", "n_tokens", "_score"}
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    right = [(r["_score"] >= module.THRESHOLD) == rule(r["text"]) for r in held]
    assert len(held) > 40 and np.mean(right) > 0.9
    odd = scores(docs_of(spark, ODD), labels.where("doc_id < 0")).collect()
    assert len(odd) == len(ODD) and all(0 <= r["_score"] <= 1 for r in odd)
    assert scores(planted.limit(0), labels).count() == 0


def test_network_is_fitted_on_all_labelled_rows(spark, planted, monkeypatch):
    """Groups: every bucket of enough labelled texts is known, the words of
    rows outside of the sample are learned, and the files' layout changes nothing."""
    monkeypatch.setattr(toxicity, "labelled_sample", partial(labelled_sample, rows=60))
    monkeypatch.setattr(toxicity, "GROUP_ROWS", 200)
    labels = labels_of(spark, planted, "toxic", lambda t: "vile" in t)
    sample = labelled_sample(planted, labels, "toxic", rows=60)
    known = all_labelled(planted, labels.unionByName(labels), "toxic")
    rows = known.table(3).toArrow()
    texts = rows.column("text").combine_chunks()
    assert known.rows == rows.num_rows > 300 and known.positives == sum(rows.column("y").to_pylist())
    assert known.bytes == sum(len(t.encode()) for t in texts.to_pylist())
    net = toxicity.fit_all(planted, labels)
    having = toxicity.tokenized(texts)[3]
    assert np.array_equal(net.rows[:-1] > 0, having >= toxicity.MIN_TEXTS)
    assert not np.array_equal(toxicity.fit(sample).rows, net.rows)
    again = toxicity.fit_all(planted.repartition(5), labels.repartition(3))
    for a, b in zip(vars(net).values(), vars(again).values()):
        assert all(map(np.array_equal, a, b)) if isinstance(a, list) else np.array_equal(a, b)
    held = [r["text"] for r in planted.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    right = (net.scores(pa.array(held)) >= 0.5) == np.array(["vile" in t for t in held])
    assert right.mean() > 0.8


def test_packed_numbers_come_back():
    rng = np.random.default_rng(2)
    slots, weights = np.arange(7, 5000, 9), rng.integers(0, 1 << 31, 555)
    values = rng.integers(-(1 << 30), 1 << 30, (555, toxicity.DIMENSIONS)).astype(np.int32)
    values[:, 0] = rng.integers(-2, 3, 555)
    found = toxicity._unpacked(toxicity._packed(slots, weights, values))
    assert all(map(np.array_equal, found, (slots, weights, values)))


def test_means_of_a_block_come_packed():
    rng = np.random.default_rng(4)
    start, both = 5 * toxicity.BLOCK, []
    total = np.zeros(toxicity.BLOCK, np.int64)
    sums = np.zeros((toxicity.BLOCK, toxicity.DIMENSIONS), np.int64)
    for _ in range(3):
        slots = start + np.flatnonzero(rng.random(toxicity.BLOCK) < 0.5)
        weights = rng.integers(0, 4, len(slots))
        values = rng.integers(-(1 << 18), 1 << 18, (len(slots), toxicity.DIMENSIONS)).astype(np.int32)
        both.append(toxicity._packed(slots, weights, values))
        total[slots - start] += weights
        sums[slots - start] += weights[:, None] * values
    found = toxicity._added(pa.table({"block": pa.array([5] * 3, pa.int32()), "packed": both}))
    kept = np.flatnonzero(total >= toxicity.MIN_TEXTS)
    assert found.column("block").to_pylist() == [5]
    assert np.array_equal(np.frombuffer(found.column("slots")[0].as_py(), "<i4"), start + kept)
    means = np.frombuffer(found.column("means")[0].as_py(), "<f4").reshape(len(kept), -1)
    assert np.array_equal(means, (sums[kept] / (total[kept, None] * float(toxicity.SCALE))).astype(np.float32))
    assert found.nbytes < 40 * len(kept)


def test_a_long_text_is_fitted_on_by_parts(monkeypatch):
    rng = np.random.default_rng(1)
    kept = [rng.normal(0, 0.3, (50, toxicity.DIMENSIONS)).astype(np.float32)]
    kept += [rng.normal(0, 0.3, (w, toxicity.DIMENSIONS, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS]
    shifts = [np.zeros(toxicity.FILTERS, np.float32) for _ in toxicity.WIDTHS]
    net = toxicity.Network(None, kept[0], kept[1:], shifts, None, None, None)
    for n in (21, 39, 40, 41, 42, 100):
        tokens = rng.integers(0, 50, (n, 1 + len(toxicity.PREFIXES)))
        raw, picked = toxicity._largest(net, tokens, np.array([0, n]))
        monkeypatch.setattr(toxicity, "PART_WORDS", 20)
        parts, own = toxicity._largest_by_parts(net, tokens)
        assert np.allclose(raw, parts, atol=1e-5)
        assert all(np.array_equal(a, b) for x, y in zip(picked, own) for a, b in zip(x, y))
    batches = list(toxicity._batches(np.arange(5), np.array([9, 9, 9, 50, 1])))
    assert [b.tolist() for b in batches] == [[0, 1], [2], [3], [4]]


def test_sample_leaves_held_out_rows_out(spark, planted):
    labels = labels_of(spark, planted, "toxic", lambda t: "vile" in t)
    sample = labelled_sample(planted, labels.unionByName(labels), "toxic", rows=50)
    kept = set(sample.texts.to_pylist())
    assert len(sample.labels) == 50
    for r in planted.collect():
        if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
            assert r["text"] not in kept


def test_machine_sums_all_pairs():
    texts = pa.array(["one two three", "ONE!! two", ""])
    f = quality.features(texts)
    rng = np.random.default_rng(1)
    size = quality.BUCKETS + quality.STATISTICS
    w, v = rng.normal(size=size), rng.normal(size=(size, 3))
    machine = quality.Machine(0.1, w, v, np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS))
    for i, score in enumerate(machine.scores(texts)):
        x = np.zeros(size)
        x[f.bucket[f.owner == i]] = f.value[f.owner == i]
        x[quality.BUCKETS :] = np.clip(f.statistics[i], -4, 4)
        at = np.flatnonzero(x)
        z = 0.1 + x @ w + sum(v[a] @ v[b] * x[a] * x[b] for a, b in itertools.combinations(at, 2))
        assert score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-6)


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load(vocabulary_path("piece_bpe_32k.model"))


def all_segmentations(vocabulary, text):
    data = f" {text}".encode()
    logs = {int(i): float(w) for i, w in zip(vocabulary.ids, vocabulary.weights)}
    spell = {vocabulary.decoded[vocabulary.starts[i] : vocabulary.starts[i + 1]].tobytes(): i for i in logs}

    def walk(at):
        if at == len(data):
            yield (), 0.0
        for end in range(at + 1, len(data) + 1):
            if (i := spell.get(data[at:end])) is not None:
                for rest, w in walk(end):
                    yield (i, *rest), w + logs[i]

    found = dict(walk(0))
    total = sum(map(math.exp, found.values()))
    return {ids: math.exp(w) / total for ids, w in found.items()}


def test_samples_follow_the_exact_probabilities(vocabulary):
    chance = all_segmentations(vocabulary, "the hat")
    n = 3000
    drawn = Sampler(vocabulary, 3, 1).run(["the hat"] * n, list(range(n)))
    first, second = {}, {}
    for samples in drawn:
        ids = [tuple(s[0].tolist()) for s in samples]
        assert len(set(ids)) == 3 and set(ids) <= set(chance)
        assert all(s[1] == pytest.approx(math.log(chance[i]), abs=1e-3) for s, i in zip(samples, ids))
        assert [s[2] for s in samples] == sorted((s[2] for s in samples), reverse=True)
        assert all(0 <= s[3] <= 1 for s in samples)
        first[ids[0]] = first.get(ids[0], 0) + 1
        second[ids[1]] = second.get(ids[1], 0) + 1
    for ids, p in chance.items():
        assert abs(first.get(ids, 0) / n - p) < 0.04
        q = sum(o * p / (1 - o) for other, o in chance.items() if other != ids)
        assert abs(second.get(ids, 0) / n - q) < 0.04
    # Inclusion scores weigh the samples so that their sum estimates one without bias.
    sums = [sum(math.exp(s[1]) / s[3] for s in samples) for samples in drawn]
    assert np.mean(sums) == pytest.approx(1, abs=0.05)


def test_unlikely_rest_is_drawn_when_likely_paths_are_gone(vocabulary):
    weights = np.full(len(vocabulary.weights), -30, np.float32)
    spell = {vocabulary.decoded[vocabulary.starts[i] : vocabulary.starts[i + 1]].tobytes(): k
             for k, i in enumerate(vocabulary.ids)}
    chances = {b" the": 0.5, b" t": 0.499, b" th": 0.0007, b" ": 0.0003, b"he": 1, b"e": 1, b"the": 1}
    for piece, p in chances.items():
        weights[spell[piece]] = math.log(p)
    changed = dataclasses.replace(vocabulary, weights=weights)
    n, third = 600, {}
    for samples in Sampler(changed, 3, 1).run(["the"] * n, list(range(n))):
        paths = [changed.decode(s[0][:1]) for s in samples]
        assert len(set(paths)) == 3
        if {b"the", b"t"} == set(paths[:2]):
            third[paths[2]] = third.get(paths[2], 0) + 1
    assert set(third) == {b"th", b""} and sum(third.values()) > 0.97 * n
    assert abs(third[b"th"] / sum(third.values()) - 0.7) < 0.07


def test_encodings_decode_to_the_texts(spark):
    model = vocabulary_path("piece_bpe_32k.model")
    docs = docs_of(spark, ODD)
    out = sampled_encodings(docs.unionByName(docs).repartition(3), model).collect()
    by_row = {}
    for r in out:
        assert r["round_trip"] and r["n_pieces"] == len(r["ids"])
        by_row.setdefault((r["doc_id"], r["sample"]), set()).add(tuple(r["ids"]))
    assert all(len(ids) == 1 for ids in by_row.values())
    assert {k[1] for k in by_row if k[0] in (0, 1)} == {0}
    assert {k[1] for k in by_row if k[0] == 6} == {1, 2}
    assert sampled_encodings(docs.limit(0), model).count() == 0


def test_decoding_is_the_library_s(vocabulary):
    import sentencepiece

    model = vocabulary_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = [t for t in ODD if t]
    for text, samples in zip(texts, Sampler(vocabulary, 2, 1).run(texts, list(range(len(texts))))):
        for ids, *_ in samples:
            assert library.decode(ids.tolist()) == text.replace("▁", " ")


def test_kept_lattices_change_no_sample(vocabulary, monkeypatch):
    rng = np.random.default_rng(5)
    words = ["hat", "the", "counting", "é漢字", "\U0001f600", "x" * 70, "a,b", "\n"]
    texts = [" ".join(rng.choice(words, 1 + int(n))) for n in rng.integers(0, 40, 60)]
    texts += [" ".join(rng.integers(0, 99999, 30).astype(str)) for _ in range(20)]

    def samples(limit, per_run):
        monkeypatch.setattr(segmentation, "KEPT_BYTES", limit)
        sampler = Sampler(vocabulary, 3, 1)
        out = []
        for at in range(0, len(texts), per_run):
            part = slice(at, at + per_run)
            out += sampler.run(texts[part], list(range(len(texts)))[part])
        assert len(sampler.kept.first) <= max(1.5 * limit, 0)
        return [[(s[0].tolist(), *s[1:]) for s in own] for own in out]

    whole = samples(1 << 20, len(texts))
    assert samples(1 << 20, 7) == whole
    assert samples(200, 7) == whole  # lattices are dropped and built again, groups are small


def test_kept_lattices_stay_in_their_room(vocabulary):
    kept = segmentation.Kept(vocabulary)
    units = [[b" the", b" hat"], [b" counting"], [b" x", b"\n"]]
    for own in units:
        data = np.frombuffer(b"".join(own), np.uint8)
        room = kept.room.get("arcs")
        names = np.arange(len(kept.hashes), len(kept.hashes) + len(own), dtype=np.uint64)
        kept.add(names, data, np.array([len(u) for u in own]))
        fits = room is not None and len(room) >= len(kept.arcs)
        assert kept.arcs.base is kept.room["arcs"] and (not fits or kept.arcs.base is room)
    every = sum(units, [])
    data = np.frombuffer(b"".join(every), np.uint8)
    one = segmentation.Lattice(vocabulary, data, np.array([len(u) for u in every]))
    nodes = np.repeat(np.arange(len(data)), 50)
    u = np.tile((np.arange(50) + 0.5) / 50, len(data))
    for a, b in zip(kept.step(nodes, u), one.step(nodes, u)):
        assert a.tolist() == pytest.approx(b.tolist(), abs=1e-6)


def test_kept_lattices_are_held_once(vocabulary, monkeypatch):
    """Adding and trimming take little beside the arcs that are kept."""
    monkeypatch.setattr(segmentation, "LATTICE_BYTES", 2000)
    rng = np.random.default_rng(3)
    sizes = rng.integers(3, 12, 12_000)
    data = rng.choice(np.frombuffer(b"hatcountinge", np.uint8), int(sizes.sum()))
    names = np.sort(rng.integers(0, 1 << 63, len(sizes)).astype(np.uint64))
    kept = segmentation.Kept(vocabulary)
    kept.add(names[:1], data[: sizes[0]], sizes[:1])
    kept.room = {c: np.empty(1 << 20, getattr(kept, c).dtype) for c in ("first", "count", "arcs")}
    for name, room in kept.room.items():
        room[: len(getattr(kept, name))] = getattr(kept, name)
        setattr(kept, name, room[: len(getattr(kept, name))])

    def taken(work):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return peak

    added = taken(lambda: kept.add(names[1:], data[sizes[0] :], sizes[1:]))
    assert kept.arcs.base is kept.room["arcs"]
    assert added < 0.75 * kept.arcs.nbytes
    kept.seen[:] = rng.permutation(len(names))
    best = np.argsort(-kept.seen)
    most = set(kept.hashes[best[np.cumsum(kept.sizes[best]) <= len(data) * 2 // 3 - 1]].tolist())
    trimmed = taken(lambda: kept.trim(len(data) * 2 // 3 - 1))
    assert trimmed < 0.75 * kept.arcs.nbytes and kept.arcs.base is kept.room["arcs"]
    assert set(kept.hashes.tolist()) == most
    one = segmentation.Kept(vocabulary)
    starts = np.cumsum(sizes) - sizes
    rows = np.searchsorted(names, kept.hashes)
    one.add(kept.hashes, data[segmentation.spans(starts[rows], sizes[rows])], sizes[rows])
    seeds = np.arange(len(rows), dtype=np.uint64)
    a, b = (k.sample(np.arange(len(rows)), seeds) for k in (kept, one))
    assert all(map(np.array_equal, vars(a).values(), vars(b).values()))


def test_less_memory_gives_the_same_samples(spark):
    texts = [(i, " ".join("w%d" % (k * k % (i + 7)) for k in range(200))) for i in range(30)]
    docs = spark.createDataFrame([*texts, (99, None)], "doc_id bigint, text string").coalesce(1)
    model = vocabulary_path("piece_bpe_32k.model")
    plain = sampled_encodings(docs, model).collect()
    assert sampled_encodings(docs, model, kept_bytes=600, slice_bytes=500).collect() == plain


def test_places_of_spans():
    for starts in ([5, 0, 9], [1 << 40, 3, 1 << 31]):
        got = segmentation.spans(np.array(starts), np.array([2, 0, 3]))
        assert got.tolist() == [starts[0], starts[0] + 1, *range(starts[2], starts[2] + 3)]
    assert len(segmentation.spans(np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0


def test_distinct_units_are_found_once_for_all_samples(vocabulary, monkeypatch):
    found = []
    plain = np.unique
    monkeypatch.setattr(np, "unique", lambda x, *a, **k: found.append(len(x)) or plain(x, *a, **k))
    texts = ["the hat counts " * 40, "the the hat x"]
    assert all(len(own) == 4 for own in Sampler(vocabulary, 4, 1).run(texts, [1, 2]))
    assert len(found) == 1
