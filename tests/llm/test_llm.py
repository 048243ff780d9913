"""The training-data operators against brute force, on small tables with nulls, empty texts, repeats and clashing columns."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paneloom.llm import ann, line_dedup, media, mixing, ngram_join, pieces, pii, quality, registry, sharding, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, size string, keep string, node string"
ODD = [None, "", " \t\n", "word", "two words", "mail a@b.c_d@e.fg and 1.2.3.4.5 x", "call +1 (743) 555-3824 now", "card 4111 1111 1111 1111 here", "é" * 300 + " x@y.zz", "a" * 30000, "A B C d e f g h i j k l m n o p"]


def table(spark, texts):
    return spark.createDataFrame([(i if i != 3 else None, t, "en", None if i % 7 == 0 else f"s{i % 3}", None, 1, "x", "y", "z") for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    base = "the quick brown fox jumps over the lazy dog while nine big wizards walk by the river bank every single morning of may".split()
    near = [" ".join(base * 3 + [f"tail{i}", "end"]) for i in range(4)]
    return table(spark, ODD + ODD[4:7] + near + [f"shared boilerplate line of text\nown line number {i} of this text" for i in range(9)]).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pandas(df):
    return df.toPandas()


def base_spans(t):
    out = []
    for k, p in enumerate([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]):
        for m in re.finditer(p, t):
            g = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) * (1 + j % 2) - 9 * (int(c) * (1 + j % 2) > 9) for j, c in enumerate(reversed(g))) % 10 == 0
            if (k == 1 and any(int(x) > 255 for x in m.group().split("."))) or (k == 2 and not (14 <= len(g) <= 19 and luhn)) or (k == 3 and not 10 <= len(g) <= 15):
                continue
            out.append((m.start(), k, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_pii(docs, empty):
    texts = [r.text for r in docs.collect()]
    want = sorted(hashlib.sha256(base_spans(t or "").encode()).hexdigest() for t in texts)
    got = pandas(pii.find_pii(docs))
    assert sorted(got.base_sha256) == want and len(got) == len(texts)
    for i, k in enumerate(pii.BASE):
        assert got[f"n_{k}"].sum() == sum(base_spans(t or "").count(f"{k}:") for t in texts)
    assert not any(got[got.n_email + got.n_ip + got.n_card + got.n_phone == 0].spans.str.contains("email:|ip:|card:|phone:"))
    assert pii.find_pii(empty).count() == 0


@pytest.mark.parametrize("k,pct", [(3, 90), (5, 80)])
def test_near_duplicates(docs, empty, k, pct):
    rows = docs.select("doc_id", "text").collect()
    sets = []
    for r in rows:
        w = (r.text or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= pct * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    name = {g: min((rows[i].doc_id for i in range(len(rows)) if group[i] == g and rows[i].doc_id is not None), default=None) for g in set(group)}
    want = sorted((r.doc_id or -1, len(s), name[g] if s else r.doc_id) for r, s, g in zip(rows, sets, group))
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs, k, pct).collect())
    assert [(a, b, c or -1) for a, b, c in got] == [(a, b, c or -1) for a, b, c in want]
    assert ngram_join.near_duplicates(empty, k, pct).count() == 0


def test_near_duplicates_of_hot_texts(spark):
    """A group of near copies above the hot bar, and texts of one common passage with tails of their own."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(60):
        w = list(base)
        for at in rng.choice(120, rng.integers(0, 3), replace=False):
            w[at] = f"x{i}"
        texts.append(" ".join(w))
    texts += [" ".join(base[:40] + [f"t{i}_{j}" for j in range(10)]) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} for t in texts]
    comp = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                lo, hi = sorted((comp[i], comp[j]))
                comp = [lo if c == hi else c for c in comp]
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(df, 3, 90).collect()}
    assert [got[i] for i in range(len(texts))] == comp


def test_near_duplicates_counts_all_links(spark, monkeypatch):
    """Each text's links within a group of hot and a group of cheap near copies, with blocks smaller than the groups."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    texts = [" ".join([f"{g}{i}" for i in range(120)] + [f"{g}x{j}_{i}" for i in range(j % 9)]) for g, m in (("a", 60), ("b", 12)) for j in range(m)]
    texts += ["a lone text of words", texts[1], None]
    sets = [{tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} if t else set() for t in texts]
    linked = lambda x, y: x != y and bool(x & y) and 100 * len(x & y) >= 90 * len(x | y)
    different = {frozenset(s) for s in sets}
    want = [sum(linked(s, o) for o in different) for s in sets]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in ngram_join.near_duplicates(df, 3, 90).collect()}
    assert [got[i].n_links for i in range(len(texts))] == want


@pytest.mark.parametrize("k,pct,seed", [(3, 90, 1), (5, 80, 2)])
def test_near_duplicates_of_families(spark, monkeypatch, k, pct, seed):
    """Families of hot texts: copies with up to a dozen edits, copies of copies, one passage with tails of their own, two families that
    share most of their text, and repeated edits. Links and components as by brute force, with small blocks and few voters."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "VOTERS", 12)
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(130)]
    cousin = base[:118] + [f"c{i}" for i in range(12)]
    texts = []
    for root, m in ((base, 70), (cousin, 50)):
        for i in range(m):
            w = list(root)
            for at in rng.choice(len(w), rng.integers(0, 9), replace=False):
                w[at] = f"x{i}" if rng.random() < 0.6 else "same"
            texts.append(" ".join(w))
    texts += [" ".join(base[:90] + [f"t{i}_{j}" for j in range(rng.integers(5, 30))]) for i in range(60)]
    texts += [" ".join(texts[0].split()[: -rng.integers(1, 12)]) for _ in range(40)] + [texts[5], "", None]
    sets = [{tuple(t.split()[i : i + k]) for i in range(len(t.split()) - k + 1)} if t else set() for t in texts]
    linked = lambda x, y: x != y and bool(x & y) and 100 * len(x & y) >= pct * len(x | y)
    different = {frozenset(s) for s in sets}
    comp = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if linked(sets[i], sets[j]) or (sets[i] and sets[i] == sets[j]):
                lo, hi = sorted((comp[i], comp[j]))
                comp = [lo if c == hi else c for c in comp]
    got = {r.doc_id: r for r in ngram_join.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), k, pct).collect()}
    assert [got[i].n_links for i in range(len(texts))] == [sum(linked(s, o) for o in different) for s in sets]
    assert [got[i].component_id for i in range(len(texts))] == comp


@pytest.mark.parametrize("seed", range(6))
def test_block_links(seed):
    """Counts of the pairs that need shared differences, over all buckets of one centre, against sets compared in full."""
    rng = np.random.default_rng(seed)
    centre = np.arange(1000, 1060)
    docs = []
    for _ in range(40):
        lacks = rng.choice(centre, rng.integers(0, 8), replace=False)
        docs.append(set(centre.tolist()) - set(lacks.tolist()) | set(rng.integers(0, 12, rng.integers(0, 5)).tolist()))
    pct, p, budget = 80, 60, 20 * 60
    diff = [np.array(sorted(d ^ set(centre.tolist()))) for d in docs]
    c = [100 * len(set(centre.tolist()) - d) + pct * len(d - set(centre.tolist())) for d in docs]
    got = np.zeros(40, int)
    for tok in set(np.concatenate(diff).tolist()):
        rows = [(0, i, p, c[i], diff[i]) for i in range(40) if tok in diff[i]] + [(1, i, p, c[i], diff[i]) for i in range(40) if tok in diff[i] and 2 * c[i] > budget]
        for a, _, m in ngram_join._block_links(tok, rows, pct):
            np.add.at(got, a, m)
    want = [sum(j != i and c[i] + c[j] > budget and 100 * len(x & y) >= pct * len(x | y) for j, y in enumerate(docs)) for i, x in enumerate(docs)]
    assert got.tolist() == want


def test_sharding(docs, empty):
    got = pandas(sharding.shard(docs, shards=4))
    assert len(got) == docs.count() and got.grown_shard.isna().all()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    shard_of = {}
    for r, t in zip(got.itertuples(), [0] * len(got)):
        assert shard_of.setdefault((r.text_crc32, r.size), r.shard) == r.shard
    assert sharding.schedule([(5, "a"), (4, "b"), (3, "c"), (3, "d"), (3, "e")], 2) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}
    assert sharding.shard(empty).count() == 0


def test_url_filter(spark):
    urls = [None, "", "nourl", "http://www.example.com/en/x?q", "http://a.example.com/en/", "https://x.COM/a#b", "http://com", "http://a.net/es/1", "http://q.org/en/9?x://y/z"]
    urls += [f"http://good{i}.com/fr/{i}" for i in range(60)] + [f"http://bad{i}.net/es/{i}" for i in range(60)]
    got = {r.page_id: r for r in url_filter.filter_urls(spark.createDataFrame([(i, u, "h", "a", "b") for i, u in enumerate(urls)], "page_id long, url string, html string, host string, rule string")).collect()}
    assert len(got) == len(urls)
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(9)] == [("", "", None), ("", "", None), ("", "", None), ("www.example.com", "/en/x", "www.example.com/en/"), ("a.example.com", "/en/", "example.com/en/"), ("x.com", "/a", "com/"), ("com", "", None), ("a.net", "/es/1", "net/es/"), ("q.org", "/en/9", None)]
    assert [got[i].verdict for i in (3, 4, 5, 7)] == ["allow", "block", "allow", "block"]
    assert got[8].score is not None and got[8].verdict in ("allow", "block")
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    for kind in ("int", "string"):
        named = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("page_id", F.col("page_id").cast(kind))
        other = {int(r.page_id): r.verdict for r in url_filter.filter_urls(named).collect()}
        assert other == {i: r.verdict for i, r in got.items()}


def test_url_model_keeps_contexts_apart(spark, monkeypatch):
    """Scores against counts by whole byte contexts, with letters beyond 7 bits; broadcast and joined values are the same."""
    rng = np.random.default_rng(7)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789éß"), 12))
    taught = [(f"http://{word()}.{end}", side) for end, side in (("com/" + word(), 0), ("net/es/" + word(), 1)) for _ in range(400)]
    free = [f"http://{word()}.org/{word()}" for _ in range(20)] + ["http://é.org/é", "http://C).org/C)", None]
    rows = [(i, u) for i, u in enumerate([u for u, _ in taught] + free)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    counts = [{}, {}]
    grams = lambda u: [tuple(([-1] * 5 + [*u.encode(), 256])[i : i + 6]) for i in range(len(u.encode()) + 1)]
    for u, side in taught:
        for g in grams(u):
            for k in range(6):
                at = counts[side].setdefault(g[5 - k : 5], {})
                at[g[5]] = at.get(g[5], 0) + 1

    def score(u):
        out = []
        for g in grams(u):
            p = [1 / 257, 1 / 257]
            for s in (0, 1):
                for k in range(6):
                    if at := counts[s].get(g[5 - k : 5]):
                        p[s] = (at.get(g[5], 0) + len(at) * p[s]) / (sum(at.values()) + len(at))
            out.append(np.log(p[0]) - np.log(p[1]))
        return np.mean(out)

    first = {r.page_id: r for r in url_filter.filter_urls(df).collect()}
    assert len(first) == len(rows) and [first[800 + i].score for i in range(len(free))] == pytest.approx([score(u or "") for u in free], abs=1e-9)
    monkeypatch.setattr(url_filter, "MOST_GRAMS", 0)
    assert {r.page_id: r for r in url_filter.filter_urls(df).collect()} == first


def test_line_dedup(docs, empty, spark):
    rows = [(i, "shared boilerplate line of text\nkept", f"s{i}") for i in range(6)] + [(9, None, None), (10, "", "s1")]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0].n_removed == 0 and all(got[i].text == "kept" and got[i].n_removed == 1 for i in range(1, 6))
    assert got[9].text is None and got[9].n_lines == 0 and got[10].text == ""
    assert line_dedup.dedup_lines(docs).count() == docs.count() and line_dedup.dedup_lines(empty).count() == 0


def brute_lines(rows, min_sites, min_chars):
    """rows: (id, text, site). Texts without lines that stand at min_sites sites, but where their owner has them."""
    has: dict = {}
    for i, t, s in rows:
        for x in (t or "").split("\n") if t is not None else []:
            if len(x.strip(" ")) >= min_chars:
                has.setdefault(x.strip(" "), []).append((i, s))
    first = {x: min((i for i, _ in at if i is not None), default=None) for x, at in has.items() if len({s for _, s in at}) >= min_sites}
    return [None if t is None else "\n".join(x for x in t.split("\n") if x.strip(" ") not in first or first[x.strip(" ")] == i) for i, t, s in rows]


@pytest.mark.parametrize("most", [1 << 21, 0])
def test_line_dedup_against_brute_force(spark, monkeypatch, most):
    """Random lines, near and above the threshold of sites, with null sites and texts, repeated rows and columns named like helpers;
    texts cleaned where they are read and by a join."""
    monkeypatch.setattr(line_dedup, "MOST_LINES", most)
    rng = np.random.default_rng(4)
    rows = [(i, "\n".join(f" line {rng.integers(0, 60)} " for _ in range(rng.integers(0, 9))) if i % 11 else None, None if i % 13 == 0 else f"s{rng.integers(0, 8)}") for i in range(200)]
    rows += [rows[7], rows[8], (900, ("line 3\n" * 5000)[:-1], "s1")]
    names = ["row", "id", "own_id", "own_row", "site", "gone", "lines", "h", "_rid", "_text", "n_lines"]
    df = spark.createDataFrame([(*r, *range(len(names))) for r in rows], "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))
    out = line_dedup.dedup_lines(df, 6, 3)
    got = out.collect()
    assert sorted((r.doc_id, str(r.text)) for r in got) == sorted((r[0], str(t)) for r, t in zip(rows, brute_lines(rows, 6, 3)))
    assert out.columns == ["doc_id", "text", "source", *names[:-1], "n_lines", "n_removed"] and all(r[n] == i for r in got for i, n in enumerate(names[:-1]))


def test_line_dedup_keeps_a_line_of_rows_without_ids(spark):
    rows = [(None, f"one shared line of many rows\nown {i}", f"s{i}") for i in range(7)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sum(r.n_removed for r in got) == 6 and sum("one shared line" in r.text for r in got) == 1


def test_line_stage_removes_short_lines(spark):
    rows = [(i, f"Les. \n \n\nown{i}\nOk", f"s{i}" if i < 5 else "s0") for i in range(8)] + [(9, "Ok", "s1"), (10, "rare", "s1")]
    got = {r.doc_id: r.text for r in corpus_pipeline.line_stage(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "").collect()}
    assert got[0] == "Les. \n \n\nown0\nOk" and all(got[i] == f" \n\nown{i}" for i in range(1, 8))
    assert got[9] == "" and got[10] == "rare"


def test_ann(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16)) + rng.integers(0, 6, (3000, 1)) * 3.0
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(5000, None, 1), (5100, [0.0] * 16, 1), (5200, [float("nan")] * 16, 1), (5300, [1.0], 1), (None, [1.0] * 16, 1)]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")).toPandas()
    hits = 0
    for q in range(0, 3000, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 11)) and np.allclose(mine.score, d[mine.vec_id.to_numpy()], rtol=1e-12)
        hits += len(set(mine.vec_id) & set(np.lexsort((np.arange(3000), d))[:10]))
    assert set(got.query_id) == set(range(0, 3000, 100)) and hits / 300 >= 0.9
    few = ann.search(spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 4.0])], "vec_id long, embedding array<double>")).collect()
    assert sorted((r["rank"], r.vec_id) for r in few) == [(1, 1), (2, 2)]
    assert ann.search(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_ann_of_repeated_query_rows(spark):
    """A repeated query row asks once, and of different vectors under one id the smallest asks."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(100, x[100].tolist()), (200, [9.0] * 8), (7, x[7].tolist())]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), want=1.0, probes=64).toPandas()
    full = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    for q in (0, 100, 200, 300):
        d = np.sqrt(((full - x[q]) ** 2).sum(1))
        d[ids == q] = np.inf
        assert got[got.query_id == q].sort_values("rank").vec_id.tolist() == ids[np.lexsort((ids, d))[:10]].tolist()


def test_ann_recall_on_the_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    known = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where("embedding is not null").toPandas()
    known = known[[v is not None and len(v) > 0 and bool(np.isfinite(np.array(v, float)).all()) and bool(np.any(v)) for v in known.v]]
    x, ids = np.array(known.v.tolist(), float), known.vec_id.to_numpy()
    got = ann.search(rows).toPandas()
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        want = set(ids[np.lexsort((ids, d))[:10]])
        hits += len(want & set(got[got.query_id == q].vec_id))
        total += len(want)
    assert hits >= 0.9 * total


def test_pieces(spark, docs, empty, monkeypatch):
    import sentencepiece

    path = registry.model_path()
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = np.random.default_rng(8)
    letters = [" ", " ", "  ", "\u2581", "a", "b", "the", "é", "e\u0301", "\u3000", "\x00", "\x07", "\n", "\t", "😀", "ﬁ", "Ⅳ", "日本", "1", ".", "<s>", "\u00a0", "\u200b"]
    odd = ["".join(rng.choice(letters, rng.integers(1, 25))) for _ in range(3000)] + ["word " * 300_000, "x" * 200_000]
    odd += ["a ", " a", "  a  b ", "▁a", "▁", " ", "   ", "x\n\ny\t z", "日本 語", "a\x00b", "▁ ▁a ▁"]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    want = []
    for r in both.collect():
        ids = sp.encode(r.text or "")
        want.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    got = pieces.encode(both, path, keep_ids=True).collect()
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want) and all(len(r.ids) == r.n_tokens for r in got)
    assert pieces.encode(empty, path).count() == 0
    monkeypatch.setattr(pieces, "RUN_CHARS", 300)
    again = pieces.encode(both.repartition(3), path).collect()
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in again) == sorted(want)


def test_mixing(docs, empty, spark):
    got = pandas(mixing.mix(docs))
    assert len(got) == docs.count() and (got.taken <= 2 * got["size"]).all()
    by = got.groupby(got.source.fillna("~")).agg({"taken": "sum", "target": "first", "source_size": "first"})
    assert ((by.taken - by.target).abs() <= 0.5).all() and by.target.sum() == pytest.approx(1.5 * got["size"].sum())
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns and copies.where("text is null or text = ''").count() == 0
    clash = docs.select("*", *[F.lit(n).alias(n) for n in ("row", "skey", "own", "cut", "passes", "key", "col", "_skey", "_copy")])
    more = mixing.mixed_documents(clash)
    assert more.columns == clash.columns and more.count() == copies.count() and more.where("row <> 'row' or cut <> 'cut' or _copy <> '_copy' or col <> 'col'").count() == 0


def test_media(docs, empty):
    got = media.store_media(docs).collect()
    want = sorted((len((r.text or "").encode()), hashlib.sha256(p := media.payload_of((r.text or "").encode())).hexdigest(), zlib.crc32(p[-16:]), hashlib.sha256(media.wav_header(len(p)) + p).hexdigest()) for r in docs.collect())
    assert sorted((r.n_bytes, r.payload_sha256, r.tail_crc32, r.media_sha256) for r in got) == want
    assert all(r.payload_bytes % 192 == 0 and r.media_bytes == r.payload_bytes + 44 for r in got)
    data = np.random.default_rng(1).integers(0, 256, 200_000, dtype=np.uint8).tobytes()
    a, b = media.cut_points(data), media.cut_points(data[777:])
    assert a[-1] == len(data) and len({x - 777 for x in a} & set(b)) > 0.9 * len(b)
    assert media.store_media(empty).count() == 0


def test_quality(spark, docs, empty):
    good, bad = "calm plain prose about rivers and hills", "SPAM!! WIN!! NOW%%% ###"
    rows = [(i, (good if i % 2 else bad) + f" w{i}", "y") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, keep string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(120)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.rate(df, labels).collect()}
    assert np.mean([got[i].keep == bool(i % 2) for i in range(120, 200)]) >= 0.95
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.keep and r.tail_prob is None for r in quality.rate(docs, none).collect())
    assert quality.rate(empty, labels).count() == 0 and quality.rate(docs, labels).count() == docs.count()


def test_pipeline(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns, name
    assert corpus_pipeline.run(spark, d).where(F.size("ids") != F.col("n_tokens")).count() == 0


def test_near_stage_removes_rows_not_ids(spark):
    """Repeated rows, null ids and an id on two texts: one row of each group stays, and no other text goes."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a, "s2"), (1, a, "s1"), (1, a, "s1"), (None, a, "s0"), (2, a, "s0"), (2, b, "s0"), (None, c, "s1"), (None, c, "s0"), (4, "", "s0"), (None, None, "s0"), (None, None, "s0")]
    out = corpus_pipeline.near_stage(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "").collect()
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, [(1, a, "s1"), (2, b, "s0"), (None, c, "s0"), (4, "", "s0"), (None, None, "s0"), (None, None, "s0")]))


def test_sketches_differ_less_than_sets():
    """The bits in which two sketches differ never exceed the elements that only one of the sets has."""
    rng = np.random.default_rng(5)
    for n in (0, 1, 3, 100, 2000):
        for m in (0, 1, 7, 700):
            x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            y = np.union1d(x[: n // 2], rng.integers(0, 2**63, m, dtype=np.uint64))
            bits = sum(bin(int(a) & (2**64 - 1)).count("1") for a in ngram_join._sketch(x) ^ ngram_join._sketch(y))
            assert bits <= len(np.setxor1d(x, y)) and (len(x) > 0 or not ngram_join._sketch(x).any())
