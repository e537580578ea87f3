"""Near-duplicates, license scans, mixing, vector searches and chat formatting
against brute force."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contestlab.llm import neighbours, stages, topk
from contestlab.llm import near_dedup as N
from contestlab.llm.chat import Branches, escaped, formatted, loss_text, turns_of, unescaped
from contestlab.llm.components import components
from contestlab.llm.licenses import license_scan
from contestlab.llm.mixing import Mix, fit, mixed
from contestlab.llm.neighbours import nearest_neighbours
from contestlab.llm.samples import all_labelled
from contestlab.llm.topk import top_scores
from contestlab.llm.words import _BASE, CHUNK_BYTES, powers

SCHEMA = "doc_id bigint, text string, source string, size string, _key string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def corpus():
    rng = random.Random(3)
    words = ["w%d" % i for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.choice([6, 60, 150]))] for _ in range(25)]
    rows = []
    for i, b in enumerate(base):
        for edits in (0, 0, 1, 2, 5):
            copy = list(b)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = "edit%d" % rng.randrange(10**6)
            rows.append((len(rows), " ".join(copy), "s%d" % (i % 3)))
    rows += [(900, None, None), (901, "", "s0"), (902, "!!", "s1"), (903, "two words", "s0")]
    rows += [(None, rows[0][1], "s0"), (3, rows[3][1], None), (904, "TWO, words", "s0")]
    rows += [(905, "long " * 30000, "s2")]
    return rows


def test_near_duplicates_equal_brute_force(spark):
    rows = corpus()
    docs = docs_of(spark, rows)
    counts, n = N.document_frequencies(docs, "text", N.Setting())
    weights = N.inverse_frequencies(counts, n)
    keys, features = N._runs(pa.array([r[1] for r in rows], pa.string()), 5)
    class_of = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if keys[a] is None or keys[b] is None:
            continue
        same = keys[a] == keys[b]
        if same or N.weighted_jaccard(features[a], features[b], weights) >= 0.8:
            old, new = sorted((class_of[a], class_of[b]), reverse=True)
            class_of = [new if c == old else c for c in class_of]
    least = {}
    for c, r in zip(class_of, rows):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = sorted((r[0] is None, r[0] or 0, least.get(c)) for c, r in zip(class_of, rows))
    found = N.near_duplicates(docs).collect()
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["class_id"]) for r in found)
    assert got == want
    kept = stages.without_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == sorted(set(least.values()))
    assert N.near_duplicates(docs.limit(0)).count() == 0
    assert N.keepers(docs.limit(0)).count() == 0


def test_packed_features_come_back_and_take_less_room():
    rng = np.random.default_rng(6)
    features = np.sort(rng.integers(0, 1 << 64, 500_000, np.uint64))[100_000:103_000]
    for own in (features, features[:1], features[:0], np.array([0, 1, (1 << 64) - 1], np.uint64)):
        counts = np.arange(len(own)) + 1
        assert N._unpacked_features(pa.array([N._packed_features(own)]))[0].tolist() == own.tolist()
        assert N._unpacked_counts(pa.array([N._packed(counts)]))[0].tolist() == counts.tolist()
    lz4 = pa.Codec("lz4_raw")
    plain, packed = (len(lz4.compress(x)) for x in (features.tobytes(), N._packed_features(features)))
    assert packed < 0.8 * plain


def test_shuffles_go_with_the_job_that_made_them(spark):
    def shuffled():
        env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
        files = env.blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {n for n in names if n.startswith("shuffle_")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    there, before = spark.conf.get(setting), shuffled()
    N.text_classes(docs_of(spark, corpus()))
    left = time.time() + 10  # they are deleted in the background
    while (more := shuffled() - before) and time.time() < left:
        time.sleep(0.2)
    assert not more
    assert spark.conf.get(setting) == there


@pytest.fixture
def no_broadcast(spark):
    """Spark would broadcast every table, and any that it does broadcast is an error."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "1g", "spark.sql.maxBroadcastTableSize": "1"}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_near_duplicates_broadcast_nothing_unmeasured(spark, no_broadcast):
    docs = docs_of(spark, corpus())
    found = N.text_classes(docs).several.collect()
    assert {r["class_id"] for r in found} >= set(range(0, 125, 5))


def test_labelled_texts_are_found_without_broadcast(spark, no_broadcast):
    docs = docs_of(spark, corpus())
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id bigint, toxic int")
    known = all_labelled(docs, labels, "toxic")
    assert known.rows > 40 and known.table(3).count() == known.rows


def test_weights_are_the_runs_own_frequencies(spark):
    # A third of the rows are copies of one text at plain similarity 0.8 to 0.86.
    rng = random.Random(8)
    base = ["b%d" % i for i in range(200)]
    plain = [base]
    for _ in range(39):
        copy = list(base)
        for at in rng.sample(range(5, 195, 10), 4):
            copy[at] = "e%d" % rng.randrange(10**9)
        plain.append(copy)
    alone = [["u%d" % rng.randrange(10**9) for _ in range(100)] for _ in range(78)]
    # Elsewhere a pair of texts: the same edits of runs that only two texts have.
    alone += [alone[0][:50] + ["x"] + alone[0][51:], alone[0][:10] + ["y"] + alone[0][11:]]
    rows = [(i, " ".join(t), "s") for i, t in enumerate([*plain, *alone])]
    docs = docs_of(spark, [*rows, (900, rows[0][1], "s")])  # an exact copy counts once
    runs = [[tuple(t[1].split()[i : i + 5]) for i in range(len(t[1].split()) - 4)] for t in rows]
    df = {}
    for own in runs:
        for run in set(own):
            df[run] = df.get(run, 0) + 1
    idf = {run: 1 + np.log((1 + len(rows)) / (1 + k)) for run, k in df.items()}
    counts, n = N.document_frequencies(docs, "text", N.Setting())
    weights = N.inverse_frequencies(counts, n)
    assert n == len(rows)
    features = N._runs(pa.array([r[1] for r in rows], pa.string()), 5)[1]
    root = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = set(runs[a]), set(runs[b])
        want = sum(idf[r] for r in x & y) / sum(idf[r] for r in x | y)
        if a == 0 and b < 40:
            assert 0.8 <= len(x & y) / len(x | y) <= 0.86 and want < 0.8
        if (a < 40 and b < 40) or (a == 40 and b > 117):
            assert N.weighted_jaccard(features[a], features[b], weights) == pytest.approx(want)
        if want >= 0.8:
            old, new = sorted((root[a], root[b]), reverse=True)
            root = [new if c == old else c for c in root]
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs).collect()}
    assert got == {**dict(enumerate(root)), 900: 0}
    assert got[118] == got[119] == 40


def test_links_of_a_large_class_are_named_as_those_checked(spark):
    base = ["b%d" % i for i in range(300)]
    copies = [base[:i] + ["e%d" % i] + base[i + 1 :] for i in range(0, 300, 3)]
    found = N.near_duplicates(docs_of(spark, [(i, " ".join(t), "s") for i, t in enumerate(copies)]))
    assert "n_links" not in found.columns
    rows = found.collect()
    assert {r["class_id"] for r in rows} == {0} and len(rows) == 100
    assert all(1 <= r["links_checked"] <= 99 for r in rows)
    assert min(r["links_checked"] for r in rows) < 99  # the classes need no more


def test_draws_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(0)
    features = rng.integers(0, 2**63, 400).astype(np.uint64)
    logs = rng.uniform(0, 2, 400).astype(np.float32)
    draws = N.Draws.table(512, 1)
    a, b = slice(0, 300), slice(100, 400)
    w = np.exp(logs.astype(np.float64))
    similar = w[100:300].sum() / w.sum()
    agree = draws.sample(features[a], logs[a]) == draws.sample(features[b], logs[b])
    assert agree.mean() == pytest.approx(similar, abs=0.08)


def test_draws_beyond_their_bound_are_not_drawn(monkeypatch):
    rng = np.random.default_rng(3)
    draws = N.Draws.table(64, 1)
    drawn = []
    plain = N.Draws._drawn
    monkeypatch.setattr(
        N.Draws, "_drawn", staticmethod(lambda r, *x: drawn.append(r.size) or plain(r, *x))
    )
    for n, heaviest in ((1, 0), (64, 3), (65, 3), (1088, 0), (5000, 0), (5000, 9)):
        features = np.sort(rng.integers(0, 2**63, n).astype(np.uint64))
        logs = rng.uniform(0, heaviest, n).astype(np.float32)
        row, turn = features % np.uint64(N.DRAW_ROWS), (features >> np.uint64(40)) % np.uint64(64)
        at = (row * np.uint64(128) + turn).astype(np.int64)[:, None] + np.arange(64)
        level = np.floor(logs[:, None] / draws.r[at] + draws.b[at])
        value = draws.log_c[at] - draws.r[at] * (level - draws.b[at] + 1)
        least, columns = value.argmin(axis=0), np.arange(64)
        levels = level[least, columns].astype(np.int64).astype(np.uint64)
        drawn.clear()
        assert (draws.sample(features, logs) == N.mix(features[least] ^ N.mix(levels))).all()
        assert sum(drawn) <= max(64 * 64, n * 64 // 4) + 64 * 64


def test_bands_of_several_texts_are_those_of_each():
    own = np.arange(3 * 64, dtype=np.uint64).reshape(3, 64)
    setting = N.Setting()
    assert N.band_hashes(own, setting) == [N.band_hashes(x, setting) for x in own]


def test_powers_are_computed_once():
    few, many = powers(_BASE, 5), powers(_BASE, CHUNK_BYTES + 100)
    assert few.tolist() == [pow(int(_BASE), k, 1 << 64) for k in range(5)]
    assert (many[:5] == few).all() and int(many[-1]) == pow(int(_BASE), CHUNK_BYTES + 99, 1 << 64)
    assert np.shares_memory(few, powers(_BASE, 7)) and not few.flags.writeable


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]
    root = {x: x for e in edges for x in e}
    for _ in range(len(root)):
        for u, v in edges:
            root[u] = root[v] = min(root[u], root[v])
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {x: r for x, r in root.items() if x != r}
    assert components(df.limit(0)).count() == 0


def test_license_scan_equals_brute_force(spark):
    texts = [
        None, "", "MIT License", "the mit\nLICENSE, mit-license x", "license mit",
        "Apache License general public license GENERAL PUBLIC", "mit Kicense İ apache",
        "Released under the MIT License. " + "z " * 20000 + "apache license",
        "redistribution and use in source and binary forms with without modification are permitted"
        " provided that the following conditions are met",
        "x released under y the mit z license", "mit license " * 50,
    ]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(2, texts[2], None), (None, texts[2], None)]
    found = license_scan(docs_of(spark, rows))
    assert "Python" not in found._jdf.queryExecution().toString()
    phrases = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
    got = sorted(found.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    lower = {i: i + 32 for i in range(65, 91)}
    for r, (_, text, _) in zip(got, order):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))
        places = [
            (i, label)
            for label, p in phrases.items()
            for i in range(len(words))
            if words[i : i + len(p.split())] == p.split()
        ]
        starts = [i for i, _ in places]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == (
            (min(starts), max(starts)) if starts else (None, None)
        )
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[8]["labels"] == "bsd" and 0.9 <= by_id[8]["score"] < 1
    assert by_id[4]["labels"] == "" and by_id[4]["score"] == 0
    assert license_scan(docs_of(spark, rows).limit(0)).count() == 0


def test_license_notice_is_found_wherever_it_begins(spark):
    notice = "released under y the mit z license"
    apart = "redistribution and use in q q source and binary forms with q q or without q q modification"
    apart += " are permitted provided that the q q following conditions q q are met"
    texts = ["x " * i + t + " x" * after for t in (notice, apart) for i in range(49) for after in (0, 60)]
    texts += ["released under a b c the d e mit f g license"]  # 12 words, two windows' worth
    texts += ["license mit the released x x x x under", "license mit the released x x x x x x x under"]
    got = {r["doc_id"]: r for r in license_scan(docs_of(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()}
    for i, text in enumerate(texts[:-3]):
        want = "mit" if notice in text else "bsd"
        assert (got[i]["labels"], got[i]["score"]) == (want, 1.0), text
    n = len(texts)
    assert [got[i]["labels"] for i in range(n - 3, n)] == ["", "mit", ""]


def test_license_bodies_are_found_without_their_openings(spark):
    bodies = {
        "mit": "The above copyright notice and this permission notice shall be included in all copies"
        " or substantial portions of the Software.",
        "apache": "Unless required by applicable law or agreed to in writing, software distributed"
        ' under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF'
        " ANY KIND, either express or implied.",
        "gpl": "This program is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR"
        " PURPOSE. See the GNU General Public License for more details.",
        "bsd": "Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer.",
    }
    rows = [(i, f"some words {t} more", None) for i, t in enumerate(bodies.values())]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan(docs_of(spark, rows)).collect()}
    assert got == {i: (label, 1.0) for i, label in enumerate(bodies)}


def test_fit_reaches_the_best_sum():
    rng = np.random.default_rng(2)
    for _ in range(40):
        sizes = rng.integers(0, 30, rng.integers(1, 10))
        budget = int(rng.integers(0, 120))
        sums = {sum(c) for k in range(len(sizes) + 1) for c in itertools.combinations(sizes, k)}
        taken = fit(rng.integers(0, 9, len(sizes)), sizes, budget, 1 << 16)
        assert sizes[taken].sum() == max(s for s in sums if s <= budget)
    sizes = rng.integers(1, 50, 3000)
    assert sizes[fit(np.arange(3000), sizes, 40000, 500)].sum() == 40000


def test_mix_meets_targets_and_repeats(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(1, 40), rng.choice("aaaabcd")) for i in range(700)]
    rows += [(None, "x y", None), (7, None, "a"), (8, "", "e"), (9, "x y", None), (9, "x y", None)]
    docs = docs_of(spark, rows)
    for pool in (4096, 40):
        out = mixed(docs, Mix(pool=pool))
        assert out.columns[-4:] == ["_size", "source_size", "target", "copies"]
        got = sorted(map(str, out.collect()))
        assert got == sorted(map(str, mixed(docs.repartition(7), Mix(pool=pool)).collect()))
        per = out.groupBy("source").agg(
            F.sum(F.col("_size") * F.col("copies")).alias("taken"),
            F.max("target").alias("target"),
            F.max("source_size").alias("all"),
            F.sum("_size").alias("sum"),
        )
        for r in per.collect():
            assert r["all"] == r["sum"] and r["target"] <= 2 * r["all"] + 1e-9
            assert r["target"] - 3 <= r["taken"] <= r["target"] + 1e-9
    total = sum(len((t or "").split()) for _, t, _ in rows)
    targets = {r["source"]: r["target"] for r in out.collect()}
    assert sum(targets.values()) <= 1.5 * total + 1e-6
    assert mixed(docs.limit(0)).count() == 0
    copies = stages.mixed_sources(spark, docs, "")
    assert copies.columns == docs.columns
    assert copies.count() == mixed(docs).agg(F.sum("copies")).first()[0]


def vectors_of(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(0, 0.2, (300, 8)).astype(np.float32)
    values[50:120] = values[50]
    rows = [(i, v.tolist()) for i, v in enumerate(values)]
    rows += [(400, None), (401, [0.0] * 8), (402, [float("nan")] + [0.1] * 7), (None, [0.1] * 8)]
    rows += [(403, [None] + [0.1] * 7), (404, [float("inf")] + [0.1] * 7), (405, []), (406, [0.5] * 3)]
    rows += [(60, values[60].tolist())]
    return rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def plain_top(rows, every, k, score, usable):
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and usable(v)]
    out = []
    for q, x in dict((i, v) for i, v in good if i % every == 0).items():
        hits = [(-score(x, v), i) for i, v in good if i != q and len(v) == len(x)]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(hits)[:k])]
    return sorted(out)


def finite(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize("shard_rows", [40, 4096])
def test_vector_searches_equal_brute_force(spark, shard_rows):
    rows, df = vectors_of(spark)

    def inner(a, b):
        total = 0.0
        for x, y in zip(a, b):
            total += x * y
        return total

    got = nearest_neighbours(df, shard_rows=shard_rows).collect()
    want = plain_top(rows, 20, 20, inner, lambda v: finite(v) and any(v))
    assert sorted(map(tuple, got)) == want

    def whole(a, b):
        return int(np.floor(256 * a) @ np.floor(256 * b))

    got = top_scores(df, shard_rows=shard_rows).collect()
    assert sorted(map(tuple, got)) == plain_top(rows, 50, 5, whole, finite)
    assert top_scores(df.limit(0)).count() == 0 and nearest_neighbours(df.limit(0)).count() == 0


def test_query_blocks_are_not_broadcast(spark, no_broadcast):
    rows, df = vectors_of(spark)

    def whole(a, b):
        return int(np.floor(256 * a) @ np.floor(256 * b))

    got = top_scores(df, shard_rows=40).collect()
    assert sorted(map(tuple, got)) == plain_top(rows, 50, 5, whole, finite)


@pytest.mark.parametrize("scale", [1, 60, 1 << 20])
def test_pruned_and_joint_blocks_find_the_same(scale):
    rng = np.random.default_rng(8)
    centres = rng.integers(-scale, scale + 1, (8, 16))
    near = centres[rng.integers(0, 8, 1500)] + rng.integers(-1, 2, (1500, 16))
    for values in (near.astype(float), rng.integers(-scale, scale + 1, (1500, 16)).astype(float)):
        ids = rng.permutation(1500)
        index, place = topk.build(ids, values), np.arange(0, 1500, 15)
        where, found, scores = topk.searcher(5)(index, ids[place], values[place])
        every = values[place] @ values.T
        every[np.arange(len(place)), place] = -np.inf
        order = np.lexsort((np.broadcast_to(ids, every.shape), -every), axis=1)[:, :5]
        assert where.tolist() == np.repeat(np.arange(len(place)), 5).tolist()
        assert found.tolist() == ids[order].ravel().tolist()
        assert scores.tolist() == np.take_along_axis(every, order, axis=1).ravel().tolist()


def test_smaller_factor_keeps_most_neighbours():
    rng = np.random.default_rng(3)
    values = rng.normal(0, 1, (12, 6))[rng.integers(0, 12, 2000)] + rng.normal(0, 0.2, (2000, 6))
    ids = np.arange(2000)
    index = neighbours.build(ids, values)
    exact, near = (neighbours.searcher(20, f)(index, ids[:50], values[:50]) for f in (1.0, 0.8))
    pairs = [set(zip(p.tolist(), found.tolist())) for p, found, _ in (exact, near)]
    assert len(pairs[0] & pairs[1]) / len(pairs[0]) >= 0.9


def test_reply_trees(spark):
    # 1 - 2 - 4, 1 - 3 (- 5 - 6); another root 7; 8 and 9 in a circle; 10 is an orphan.
    parents = {1: None, 2: 1, 3: 1, 4: 2, 5: 3, 6: 5, 7: None, 8: 9, 9: 8, 10: 77}
    score = {1: 0.0, 2: 9.0, 3: 1.0, 4: 3.0, 5: 8.0, 6: 1.0, 7: 0.5, 10: None}
    rows = [
        ("t", i, p, "user" if i % 2 else "assistant", f"<|end|>\\{i}\\", score.get(i))
        for i, p in parents.items()
    ]
    schema = "tree string, node int, parent int, role string, text string, score double"
    out = formatted(spark.createDataFrame(rows, schema), Branches(keep=2))
    out = out.withColumn("turns", turns_of(F.col("formatted")))
    out = out.withColumn("answers", loss_text(F.col("formatted"), F.col("loss"))).collect()
    paths = {r["leaf"]: [int(t["text"].strip("<|end>\\")) for t in r["turns"]] for r in out}
    assert paths == {4: [1, 2, 4], 6: [1, 3, 5, 6]}
    for r in out:
        assert [t["role"] for t in r["turns"]] == ["user" if i % 2 else "assistant" for i in paths[r["leaf"]]]
        assert r["answers"] == "".join(f"<|end|>\\{i}\\" for i in paths[r["leaf"]] if i % 2 == 0)


def test_escapes_are_reversible(spark):
    signs = ["\\", "<", "|", ">", "a"]
    texts = ["".join(t) for n in range(6) for t in itertools.product(signs, repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("b"))
    for r in rows.collect():
        assert r["b"] == r["t"] and "<|" not in r["e"]
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_texts_of_one_template_do_not_all_meet(spark):
    # A third of the texts share 85 % of their words; they are too unlike to be linked.
    template = ["t%d" % i for i in range(170)]
    words = [[*template, *["u%d_%d" % (i, k) for k in range(30)]] for i in range(60)]
    words += [["v%d_%d" % (i, k) for k in range(200)] for i in range(120)]
    docs = docs_of(spark, [(i, " ".join(w), "s") for i, w in enumerate(words)])
    counts, n = N.document_frequencies(docs, "text", N.Setting())
    signed = N.signatures(docs, N.inverse_frequencies(counts, n), "text", N.Setting())
    keyed = N.row_keys(docs.select("doc_id", "text"), "text").join(docs.select("doc_id", "text"), "doc_id")
    texts = keyed.join(signed.select("key", "df"), "key").withColumn("class", F.col("key"))
    assert N.pairs_by_prefix(texts.select("key", "class", "text", "df"), n, N.Setting()).count() == 0
    assert N.near_duplicates(docs).select("class_id").distinct().count() == len(words)


def test_near_inner_is_exact_where_it_counts():
    """All pairs that may be among the best are exact, also where a matrix product
    rounds otherwise, with equal vectors, barred pairs and numbers without bound."""
    rng = np.random.default_rng(4)
    queries, vectors = rng.normal(size=(30, 50)), rng.normal(size=(200, 50)) * 1e3
    vectors[100:150] = vectors[:50]
    barred = rng.random((30, 200)) < 0.1
    full = np.stack([neighbours.inner(np.tile(q, (200, 1)), vectors) for q in queries])
    least = np.quantile(full, 0.5, axis=1)
    found = neighbours.near_inner(queries, vectors, least, 20, barred)
    for i in range(30):
        open_ = np.flatnonzero(~barred[i])
        best = open_[np.argsort(-full[i, open_], kind="stable")[:20]]
        kept = np.flatnonzero(found[i] > -np.inf)
        assert set(best) <= set(kept) and not barred[i, kept].any() and len(kept) < 60
        assert np.array_equal(found[i, kept], full[i, kept])
    huge = neighbours.near_inner(queries * 1e200, vectors * 1e200, least, 20, barred)
    assert not np.isfinite(huge).any()


def test_texts_of_one_template_do_not_meet_by_steps(spark):
    """Texts that share most of their weight, but too little to be linked: what meets
    grows with the texts, not with their pairs; similar texts all meet."""
    from contestlab.llm.near_dedup import reaching_pairs

    schema = "feature bigint, a binary, a_class binary, a_rest double, a_total double"

    def rows(n, rest):
        return [
            (f, b"%05d" % i, b"%05d" % i, rest, 100.0 + (i % 7) * 0.01) for i in range(n) for f in (1, 2, 3)
        ]

    far = spark.createDataFrame(rows(2000, 85.0), schema)
    assert reaching_pairs(far, 0.8).count() == 0
    near = spark.createDataFrame(rows(300, 95.0), schema)
    assert reaching_pairs(near, 0.8).count() == 300 * 299 // 2
    mixed = rows(40, 99.0) + [(1, b"x%04d" % i, b"x%04d" % i, float(w), float(w)) for i, w in enumerate(range(70, 131))]
    got = {tuple(map(bytes, r)) for r in reaching_pairs(spark.createDataFrame(mixed, schema), 0.8).collect()}
    part = 0.8 / 1.8 * (1 - 1e-6)
    want = set()
    for p, q in itertools.combinations(mixed, 2):
        if p[0] == q[0] and p[1] != q[1] and min(p[3], q[3]) >= (p[4] + q[4]) * part:
            want.add((min(p[1], q[1]), max(p[1], q[1])))
    assert got == want


def test_a_text_in_a_third_of_the_rows_is_one_row_of_its_group(spark):
    rows = [(i, "the one text that all tasks have" if i % 3 == 0 else f"own text {i}", "s") for i in range(600)]
    sent = N.keyed_texts(docs_of(spark, rows).repartition(20), "text", 4)
    assert sent.count() == 401 == sent.select("key").distinct().count()
