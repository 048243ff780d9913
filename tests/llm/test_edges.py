"""The learned and scheduled parts of the training-data operators against plain forms, and edge cases of the pipeline's stages."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paneloom.llm import media, pii, quality, sharding


def test_pii_adds_what_labelers_agree_on(spark):
    """Secrets behind cue words and spelled-out addresses are added; long words with digits and numbers of books are not."""
    rng = np.random.default_rng(1)
    some = lambda n: "".join(rng.choice(list("abcdefghjkmnpqrstuvwxyzABCDEFGH23456789"), n))
    rows = []
    for i in range(400):
        secret = f"{some(6)}7{some(5)}4{some(5)}93{some(4)}"
        rows.append((i, [f'the key="{secret}" is here', f"mail: bob{i} [at] example [dot] com now", f"see isbn {rng.integers(10**9, 10**10)}111 there", "plain-words-of-chapter-7--------- only"][i % 4]))
    out = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert np.mean([out[i].spans.startswith("secret:") for i in range(0, 400, 4)]) >= 0.9
    assert np.mean([out[i].spans.startswith("email_like:") for i in range(1, 400, 4)]) >= 0.9
    assert np.mean([out[i].spans == "" for i in range(2, 400, 4)]) >= 0.8 and np.mean([out[i].spans == "" for i in range(3, 400, 4)]) >= 0.9
    assert all(r.n_added == (r.spans != "") for r in out.values())


def test_pii_em_finds_reliabilities(spark):
    """Votes drawn with known reliabilities: the better labeler gets the larger log odds."""
    rng = np.random.default_rng(2)
    counts: dict = {}
    for _ in range(6000):
        truth = rng.random() < 0.5
        cells = tuple(3 * j + 1 + (1 if (rng.random() < p) == truth else -1) for j, p in enumerate((0.95, 0.85, 0.7, 0.55))) + (12, 19, 23)
        counts[cells] = counts.get(cells, 0) + 1
    df = spark.createDataFrame([(list(c), float(n)) for c, n in counts.items()], "cells array<int>, n double").groupBy().agg(F.array_sort(F.collect_list(F.struct("cells", "n"))).alias("pats"))
    w = df.select(pii._em(F.col("pats"), 40).alias("m")).first().m.w
    odds = [w[3 * j + 2] - w[3 * j] for j in range(4)]
    want = [2 * np.log(p / (1 - p)) for p in (0.95, 0.85, 0.7, 0.55)]
    assert odds[0] > odds[1] > odds[2] > odds[3] and np.allclose(odds, want, atol=0.8)


def test_pii_of_a_long_text(spark):
    text = " ".join(f"a{i}@b.cd tok{i}efgh1234ijkl" for i in range(1500))
    row = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_email == 1500 and row.spans.count("email:") == 1500


def test_shards_are_as_even_as_plain_scheduling(spark):
    """Groups of equal texts, a few of them large: the largest shard is that of scheduling every group."""
    rng = np.random.default_rng(3)
    rows, i = [], 0
    for g in range(1500):
        for _ in range(1 + int(rng.pareto(1.5))):
            rows.append((i, f"text {g} " + "x" * (g % 300)))
            i += 1
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=8).toPandas()
    sizes = got.merge(__import__("pandas").DataFrame(rows, columns=["doc_id", "text"]), on="doc_id").groupby("text")["size"].sum()
    loads = np.zeros(8, np.int64)
    for n in sorted(sizes, reverse=True):
        loads[loads.argmin()] += n
    mine = got.groupby("shard")["size"].sum()
    assert len(got) == len(rows) and mine.sum() == loads.sum() and mine.max() == loads.max()


def test_sizes_are_scheduled_as_single_items():
    """Counts of sizes give the loads of one heap over all items, with many items of a size, ties, and more shards than items."""
    rng = np.random.default_rng(5)
    for shards in (1, 3, 8):
        for _ in range(30):
            classes = {int(s): int(n) for s, n in zip(rng.integers(1, 60, 12), rng.choice([1, 2, 7, 40, 500], 12))}
            items = [(size, f"{size}:{i}") for size, n in classes.items() for i in range(n)]
            plain, mine = np.zeros(shards, int), np.zeros(shards, int)
            for name, s in sharding.schedule(items, shards).items():
                plain[s] += int(name.split(":")[0])
            for size, ends, to in sharding.schedule_sizes(classes.items(), shards):
                assert ends[-1] == classes[size]
                mine[to] += np.diff([0, *ends]) * size
            assert mine.tolist() == plain.tolist()
    assert sharding.schedule_sizes([(0, 4)], 2) == [(0, [4], [0])] and sharding.schedule_sizes([], 2) == []


def test_shard_loads_are_those_of_one_heap(spark):
    """Equal sizes, a hot group and null texts: each shard has the very load of scheduling every group, with and without broadcasts."""
    texts = [f"t{i:04d}" for i in range(900)] + [None] * 40 + ["hot"] * 700 + ["x" * (i % 50) + str(i) for i in range(600)] * 2
    docs = spark.createDataFrame([(None if i % 97 == 0 else i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, shard int")
    sizes = {}
    for t in texts:
        sizes[t or ""] = sizes.get(t or "", 0) + len(t or "") + 16
    plain = np.zeros(5, int)
    for name, s in sharding.schedule([(n, t) for t, n in sizes.items()], 5).items():
        plain[s] += sizes[name]
    for most in (0, 1000):
        got = sharding.shard(docs, shards=5, most_sizes=most).toPandas()
        assert len(got) == len(texts) and got.groupby("shard")["size"].sum().tolist() == plain.tolist()
        assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
        assert got.groupby(["text_crc32", "size"]).shard.nunique().max() == 1


def test_media_feature_is_of_the_stored_samples(spark):
    texts = [None, "", "a", "é" * 1000, "word " * 20000, "word " * 20000]
    got = media.store_media(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        payload = media.payload_of((texts[r.doc_id] or "").encode())
        side = [x >= 128 for x in payload]
        crossings = sum(a != b for a, b in zip(side, side[1:]))
        assert r.feature == f"{len(media.cut_points(payload))}:{sum(payload)}:{sum(x * x for x in payload)}:{crossings}:{max(payload)}"


def test_quality_probabilities_by_hand(spark):
    """Expected grade and tail probability of a fitted model from its weights and thresholds, one text at a time."""
    texts = ["calm plain prose about rivers", "SPAM!! WIN!!", "", "a b c d e f g"]
    rows = [(i, ("calm prose of rivers " if i % 3 == 2 else "odd stuff " if i % 3 else "SPAM!! WIN ") + f"w{i}") for i in range(90)]
    labels = [(i, int(i % 3 != 1), int(i % 3 == 0)) for i in range(90)]
    model = quality.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    grade, tail = model.judged(pa.array(texts))
    for i, t in enumerate(texts):
        score = sum(v * model.weights[f] for _, rows_, fs, vs in quality.features(pa.array([t])) for f, v in zip(fs, vs))
        above = [1 - 1 / (1 + np.exp(-(theta - score))) for theta in model.theta]
        assert grade[i] == pytest.approx(sum(above), abs=1e-5) and tail[i] == pytest.approx(above[-1], abs=1e-5)
    assert list(model.theta) == sorted(model.theta)


def test_quality_fit_is_near_the_optimum():
    """The fitted loss against that of a plain dense fit of the same model, by gradient steps with halving, from the same data."""
    rng = np.random.default_rng(2)
    n, words = 240, 12
    grade = rng.integers(0, 3, n)
    start, feature, value = [0], [], []
    for g in grade:
        near = np.clip(g * 4 + rng.integers(-3, 7, 5), 0, words - 1)
        own = np.unique(near)
        feature += own.tolist()
        value += [1 / np.sqrt(len(own))] * len(own)
        start.append(len(feature))
    model = quality.CumulativeLink.__new__(quality.CumulativeLink)
    rows = np.repeat(np.arange(n), np.diff(start))
    weights, theta = model._fitted(grade, rows, np.array(feature), np.array(value))
    dense = np.zeros((n, words))
    dense[rows, feature] = value
    counts = np.bincount(grade)
    weight = (n / (3 * counts))[grade] / n

    def loss(params):
        cuts = np.concatenate([[-np.inf], [params[words], params[words] + np.exp(params[words + 1])], [np.inf]])
        score = dense @ params[:words]
        tail = lambda edge: 1 / (1 + np.exp(-np.clip(edge - score, -40, 40)))
        chance = np.maximum(tail(cuts[grade + 1]) - tail(cuts[grade]), 1e-9)
        return -(weight * np.log(chance)).sum() + 1e-6 * (params[:words] ** 2).sum()

    params, rate = np.zeros(words + 2), 1.0
    here = loss(params)
    for _ in range(1500):
        slope = np.array([(loss(params + d) - loss(params - d)) / 2e-6 for d in np.eye(words + 2) * 1e-6])
        while rate > 1e-9 and loss(params - rate * slope) > here:
            rate /= 2
        params, rate = params - rate * slope, rate * 1.5
        here = min(here, loss(params))
    mine = loss(np.concatenate([weights[:words], [theta[0], np.log(theta[1] - theta[0])]]))
    assert not weights[words:].any() and mine <= here + 0.01 and here < 1.0


def test_quality_on_held_out_labels(spark):
    """Fitted on two thirds of the given labels; on the rest it keeps the good rows and rejects the others."""
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(3)))
    got = quality.rate(docs, labels.where("part > 0").drop("part")).join(labels.where("part = 0"), "doc_id")
    share = {(r.quality, r.toxic): r.k for r in got.groupBy("quality", "toxic").agg(F.avg(F.col("keep").cast("int")).alias("k")).collect()}
    assert share[1, 0] >= 0.98 and all(k <= 0.2 for (q, t), k in share.items() if q == 0 or t == 1)


ROWS = [(1, "one two three four five six\nshared line of text", "s1"), (1, "one two three four five six\nshared line of text", "s1"), (None, None, None), (3, "", "s2"), (4, " \n\t ", None), (None, "word " * 5000, "s1"), (6, "x" * 50000, "s2"), (7, "é ▁ \x00 b", "s3")]
EXTRA = {n: n for n in ("row", "h", "node", "grp", "part", "size", "key", "skey", "own", "cut", "lines", "gone", "_row", "_id", "_text", "run", "blob", "keep", "tail_prob", "n_tokens")}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_any_row(spark, tmp_path, name, stage):
    """Nulls, empty and very long texts, repeated rows, and columns with the names of helpers; and a table without rows."""
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string").withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long")).withColumns({k: F.lit(v) for k, v in EXTRA.items()})
    docs = docs.withColumns({"a.b": F.lit(1), "map": F.create_map(F.lit("x"), F.lit(1))})
    out = stage(spark, docs, str(tmp_path))
    got = out.collect()
    if name != "pieces":
        assert out.columns == docs.columns and all(r[k] == v for r in got for k, v in EXTRA.items())
    want = {"quality": 8, "lines": 8, "near_duplicates": 7, "pieces": 8}
    assert len(got) == want[name] if name in want else all(r.text and r.text.strip() for r in got)
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
