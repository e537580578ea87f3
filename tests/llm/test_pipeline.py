"""The pipeline as a whole, the sample that classifiers are fitted on, long texts,
turns of conversations and targets of the mix."""

import hashlib
import os
import random
import resource
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from contestlab.llm import quality, toxicity
from contestlab.llm import words as W
from contestlab.llm.chat import ORACLE as CHAT_SQL
from contestlab.llm.mixing import mixed
from contestlab.llm.neighbours import nearest_neighbours
from contestlab.llm.queries import QUERIES
from contestlab.llm.samples import labelled_sample
from contestlab.llm.topk import top_scores
from contestlab.sources import scratch

WORDS = ["".join(random.Random(i).choices("aeioustrnlm", k=6)) for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Good texts, junk, toxic texts, copies, odd rows, and columns that the
    stages use themselves."""
    rng = random.Random(1)
    rows = []
    for i in range(360):
        text = prose(rng, rng.randrange(30, 90))
        if i % 4 == 1:
            text = " ".join(w + "###" for w in text.split())
        if i % 4 == 2:
            text = text.replace(" ", " vileness ", 3)
        rows.append((i, text, "en", "s%d" % (i % 3)))
    labels = [(r[0], int(i % 4 != 1), int(i % 4 == 2)) for i, r in enumerate(rows)]
    near = rows[0][1].split()
    near[3] = "changed"
    long = " ".join([prose(random.Random(2), 80)] * 2)
    rows += [(400, rows[0][1], "en", "s0"), (401, long, "fr", None), (402, long + " more", "fr", "s1")]
    rows += [(403, None, None, "s1"), (404, "", "de", "s2"), (405, None, "en", None), rows[4], rows[4]]
    folder = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id bigint, text string, lang string, source string"
    docs = spark.createDataFrame(rows, schema).selectExpr(
        "*", "doc_id * 2 AS score", "'k' AS _key", "1 AS copies", "lang AS size", "2 AS sample"
    )
    docs.write.parquet(f"{folder}/documents.parquet")
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    table.write.parquet(f"{folder}/labels.parquet")
    return folder, rows, docs


def test_pipeline_takes_every_stage_s_decisions(spark, corpus):
    folder, rows, docs = corpus
    base = scratch.scratch_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    out = corpus_pipeline.run(spark, folder).collect()
    assert len({n for n in set(os.listdir(base)) - before if not n.startswith("encoding")}) == 0

    kept, seen = docs, {}
    with scratch.scratch_scope(spark) as scope:
        for name, stage in corpus_pipeline.STAGES[:4]:
            kept = scope.keep(stage(spark, kept, folder), name)
            assert kept.columns == docs.columns
            seen[name] = [r["doc_id"] for r in kept.collect()]
    text = {r[0]: r[1] for r in rows}
    own = [i for i in seen["quality"] if i < 360]
    assert sum(i % 4 == 1 for i in own) < 9 and sum(i % 4 != 1 for i in own) > 255
    own = [i for i in seen["toxicity"] if i < 360]
    assert sum(i % 4 == 2 for i in own) < 9 and sum(i % 4 in (0, 3) for i in own) > 170
    assert set(seen["toxicity"]) <= set(seen["quality"])
    left = seen["near_dedup"]
    assert set(left) <= set(seen["toxicity"]) and len(left) == len(set(left))
    words = {i: (text[i] or "").split() for i in left}
    assert not {400} & set(left) and not {401, 402} <= set(left)
    distinct = [tuple(w) for w in words.values() if w]
    assert len(distinct) == len(set(distinct)) and len(left) > 0.9 * len(set(seen["toxicity"])) - 4
    assert set(seen["mixing"]) <= set(left)
    assert {r["doc_id"] for r in out} == set(seen["mixing"]) and all(r["round_trip"] for r in out)


def test_pipeline_without_documents(spark, corpus, tmp_path):
    folder, _, docs = corpus
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_labels_of_absent_documents_take_no_place_in_the_sample(spark):
    docs = spark.range(400).selectExpr("id * 500 AS doc_id", "concat('text ', id) AS text", "1 AS y")
    labels = spark.range(200000).selectExpr("id AS doc_id", "int(id % 2) AS toxic", "id AS text")
    own = [i * 500 for i in range(400) if zlib.crc32(str(i * 500).encode()) % 5]
    assert len(labelled_sample(docs, labels, "toxic").labels) == len(own) > 300
    assert len(labelled_sample(docs, labels, "toxic", rows=100).labels) == 100
    assert len(labelled_sample(docs, labels, "toxic", text_bytes=6).labels) < 20


# Long texts


@pytest.mark.parametrize("chunk", [1, 7, 64, 300])
def test_words_of_chunks_are_those_of_the_whole(chunk):
    rng = random.Random(0)
    texts = [None, "", "a b", "x" * 50, "éa, b\n\nc  d"]
    texts += ["".join(rng.choice("abé ,.\nXY1") for _ in range(rng.randrange(300))) for _ in range(50)]
    whole, parts = (W.batch_words(pa.array(texts), (2, 4), c) for c in (1 << 20, chunk))
    for name in ("hashes", "offsets", "lengths"):
        assert np.array_equal(getattr(whole, name), getattr(parts, name))
    assert all(np.array_equal(a, b) for a, b in zip(whole.prefixes, parts.prefixes))


def random_network():
    r = np.random.default_rng(0)
    rows = np.arange(toxicity.BUCKETS + 1) % 5000
    rows[-1] = 0
    embeddings = r.normal(size=(5000, toxicity.DIMENSIONS)).astype(np.float32)
    embeddings[0] = 0
    f = toxicity.FILTERS
    kernels = [r.normal(size=(w, toxicity.DIMENSIONS, f)).astype(np.float32) for w in toxicity.WIDTHS]
    shifts = [r.normal(size=f).astype(np.float32) for _ in kernels]
    output = r.normal(size=f * len(kernels)).astype(np.float32)
    return toxicity.Network(rows, embeddings, kernels, shifts, output, np.ones(1, np.float32), np.zeros(5))


@pytest.mark.parametrize("part", [1, 2, 3, 50, 1 << 17])
def test_network_equals_plain_loops(monkeypatch, part):
    """Every filter at every place of every text, also where texts are gone
    through in parts."""
    monkeypatch.setattr(toxicity, "PART_WORDS", part)
    net, rng = random_network(), random.Random(5)
    texts = ["", "one", "one two", "one two three", None] + [prose(rng, n) for n in (4, 5, 49, 50, 51, 120)]
    column = pa.array(texts)
    words = W.batch_words(column, toxicity.PREFIXES)
    tokens = net.rows[toxicity.buckets(words)]
    got = net.answers(tokens, words.offsets)
    for i in range(len(texts)):
        own = tokens[words.offsets[i] : words.offsets[i + 1]]
        vectors = [net.embeddings[t].astype(np.float64).sum(axis=0) for t in own] or [np.zeros(toxicity.DIMENSIONS)]
        n, blank = len(vectors), np.zeros(toxicity.DIMENSIONS)
        pooled = []
        for kernel, shift in zip(net.kernels, net.shifts):
            for f in range(toxicity.FILTERS):
                at = [
                    sum(
                        float((vectors[p + o] if p + o < n else blank) @ kernel[o][:, f])
                        for o in range(len(kernel))
                    )
                    for p in range(n)
                ]
                pooled.append(max(0.0, max(at) + float(shift[f])))
        want = float(np.array(pooled) @ net.output) + 1.0
        assert got[i] == pytest.approx(want, rel=1e-3, abs=1e-3)


def test_a_long_text_has_the_features_of_its_parts(monkeypatch):
    texts = pa.array([prose(random.Random(3), 300).replace(" ", "\n", 20) + "Ab1,", "", "x y\n\nx y"])
    whole = quality.features(texts)
    data, offsets = W.text_bytes(texts)
    starts, ends = W.spans(data != 10, offsets)
    found = quality.line_hashes(data, offsets)
    assert np.array_equal(found[0], starts)
    assert np.array_equal(found[1], W.hash_spans(data, starts, ends)[0])
    monkeypatch.setattr(quality, "CHUNK_BYTES", 16)
    parts = quality.features(texts)
    for name in ("owner", "bucket", "value", "statistics"):
        assert np.array_equal(getattr(whole, name), getattr(parts, name))


def peak_growth(work):
    """Memory in MB that ``work`` takes beyond what a process like this one has."""
    read, write = os.pipe()
    child = os.fork()
    if not child:
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        work()
        grown = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before
        os.write(write, str(grown // 1024).encode())
        os._exit(0)
    os.waitpid(child, 0)
    os.close(write)
    return int(os.read(read, 20))


@pytest.mark.parametrize("operator", ["toxicity", "quality"])
def test_a_long_text_takes_bounded_memory(operator):
    """A text of 8 MB in one slice and one line: less than 25 times its bytes."""
    text = pa.array([prose(random.Random(4), 1_200_000)])
    if operator == "toxicity":
        net = random_network()
        assert peak_growth(lambda: net.scores(text)) < 200
    else:
        size = quality.BUCKETS + quality.STATISTICS
        fixed = np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS)
        machine = quality.Machine(0.0, np.zeros(size), np.zeros((size, 2)), *fixed)
        assert peak_growth(lambda: machine.scores(text)) < 200


# Conversations, mix, searches


def test_turns_with_nulls_ties_repeats_and_markers(spark, tmp_path):
    rows = [
        (1, 0, "user", "hi"), (1, 0, "assistant", "tie"), (1, 0, "user", "hi"), (1, None, "user", "first"),
        (2, 1, None, None), (2, 0, "assistant", None), (None, 5, "assistant", "no id"), (None, 4, "user", ""),
        (-7, 9, "assistant", "already there"), (3, 0, "assistant", "<|turn|>\\<\\|end|> <|"),
        (4, 0, "<|text|>", "\\"), (5, 0, "assistant", "word " * 50000),
    ]
    schema = "conv_id bigint, turn bigint, role string, text string"
    table = spark.createDataFrame(rows, schema).selectExpr("*", "'x' AS tree", "1 AS node", "2 AS score")
    path = str(tmp_path / "conversations.parquet")
    table.write.parquet(path)
    found = QUERIES["op2_chat_format"](spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    want = duck.execute(CHAT_SQL).fetchall()
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
    by_id = {r["conv_id"]: r for r in found.collect()}
    assert by_id[1]["n_turns"] == 4 and by_id[-7]["n_turns"] == 3 and by_id[None]["n_turns"] == 2
    empty = str(tmp_path / "none")
    table.limit(0).write.parquet(f"{empty}/conversations.parquet")
    only = QUERIES["op2_chat_format"](spark, empty).collect()
    assert [r["conv_id"] for r in only] == [-7]
    assert only[0]["loss_sha256"] == hashlib.sha256(b"\\### Assistant: </turn> ok").hexdigest()


def plain_targets(sizes):
    """Shares by weight, the excess of sources at their limit shared again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, out, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        left = total - sum(out.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            return out | share
        out |= {s: 2.0 * sizes[s] for s in over}
        open_ -= over
    return out


def test_mix_targets_are_those_of_plain_arithmetic(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randrange(1, 40), rng.choice(["b", "é", "a", "Z", None, "tiny"])) for i in range(500)]
    rows = [r for r in rows if r[2] != "tiny" or r[0] < 40] + [(900, None, "empty"), (901, "", "a")]
    out = mixed(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + (text or "").count("w")
    want = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)


@pytest.mark.parametrize("search", [nearest_neighbours, top_scores])
def test_searches_with_clashing_columns(spark, search):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist(), "x", 1, 2, "y") for i in range(100)]
    schema = "vec_id bigint, embedding array<double>, v string, dim int, shard int, block string"
    wide = spark.createDataFrame(rows, schema)
    plain = wide.select("vec_id", "embedding")
    assert sorted(search(wide).collect()) == sorted(search(plain).collect()) != []
