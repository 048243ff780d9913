"""SimHash groups, tokenizer alignment and the Merkle manifest, each against a plain form of its own."""

import bisect
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneloom.llm import alignment, merkle, registry, simhash

SPACES = "[^\x20\x09-\x0d]+"
ODD = [
    "", None, " ", "  ", "a ", "a  b", "a\n  b", "a\n b \n\n c", "▁x", "x ▁y z", "<|endoftext|> a<|endoftext|>b", "<s> </s>", "\x1c a\x1c\x1cb!!\x1c !!",
    "don't 's it''s", "é漢字🙂🙂 ok", "\t\ttab\tb  \t c", "a\x00b", "x  y \u0085z  ", "<0x41> <unk>", " a   b", "a \n", "\n\n a", "Word " * 3000,
]


# --- Merkle manifest


def digest(*nodes):
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def plain_leaf(*fields):
    return digest(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields])


def plain_tree(leaves):
    ways, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for way, i in zip(ways, at):
            way.append((i % 2, nodes[i ^ 1]) if i ^ 1 < len(nodes) else None)
        nodes, at = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)], [i // 2 for i in at]
    return nodes[0] if nodes else None, ways


def plain_manifest(rows):
    groups = {}
    for r in rows:
        doc_id, source, lang, n_chars, text = r
        changed = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        claimed = plain_leaf(doc_id, source, lang, n_chars + 1, text) if changed else plain_leaf(*r)
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, plain_leaf(*r), doc_id, claimed))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = [(sorted(groups[x]), *plain_tree([r[2] for r in sorted(groups[x])])) for x in names]
    root, tops = plain_tree([t[1] for t in trees])
    out = []
    for (own, subroot, ways), top in zip(trees, tops):
        for (_, _, leaf, doc_id, node), way in zip(own, ways):
            for step in way + top:
                node = digest(node) if step is None else digest(step[1], node) if step[0] else digest(node, step[1])
            out.append((doc_id, leaf, subroot, root, digest(*[s[1] for s in way + top if s]), node, node == root))
    return out


def manifest_rows(spark, rows, folder):
    kind = "doc_id long, source string, lang string, n_chars long, text string"
    frame = spark.createDataFrame(rows, kind).withColumns({"grp": F.lit(1), "a.b": F.lit(2), "row": F.create_map(F.lit("x"), F.lit(1)), "key": F.lit("k")})
    path = f"{folder}/documents.parquet"
    frame.repartition(3).write.parquet(path)
    return [tuple(r) for r in registry.op13_merkle(spark, str(folder)).collect()]


def test_manifest_equals_a_plain_tree(spark, tmp_path):
    rng = np.random.default_rng(3)
    langs = [None, "de", "en", "en", "en", "é", ""]
    rows = [(int(i), f"s{i % 3}", langs[rng.integers(7)], int(i % 50), f"text {i}") for i in range(700)]
    rows += [(None, None, "en", None, None), (None, "s", "en", 4, ""), (5, "s", "only", 1, "lone"), (14, "x", "en", None, "y" * 200_000)]
    rows += [rows[3], rows[3], (rows[3][0], "other", *rows[3][2:])]
    got = manifest_rows(spark, rows, tmp_path)
    assert sorted(got, key=str) == sorted(plain_manifest(rows), key=str)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 4


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_small_manifests(spark, tmp_path, n):
    for name, langs in (("one", ["en"] * n), ("each", [None, "b", "a"][:n])):
        rows = [(i, "s", lang, 1, "t") for i, lang in enumerate(langs)]
        (tmp_path / name).mkdir()
        assert sorted(manifest_rows(spark, rows, tmp_path / name)) == sorted(plain_manifest(rows))


def test_a_wrong_claim_is_not_verified(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(9)], "id string, body string")
    made = merkle.manifest(docs, fields=("id", "body"), group="body", order="id")
    good = merkle.fold(made, F.lit(None).cast("binary")).collect()
    assert all(r.verified for r in good) and {type(r.id) for r in good} == {str}
    assert not any(r.verified for r in merkle.fold(made, F.unhex(F.sha2("id", 256))).collect())


# --- SimHash


def plain_fingerprint(text):
    import xxhash

    words = re.findall(SPACES, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(items):
    """items (id, fingerprint): the least id that each reaches."""
    at = list(range(len(items)))

    def top(x):
        while at[x] != x:
            at[x] = at[at[x]]
            x = at[x]
        return x

    bits = np.array([f for _, f in items], np.uint64)
    for i in range(len(items)):
        for j in np.flatnonzero(np.bitwise_count(bits[i] ^ bits[i + 1 :]) <= simhash.RADIUS) + i + 1:
            at[top(int(j))] = top(i)
    least = {}
    for i, (doc_id, _) in enumerate(items):
        least.setdefault(top(i), []).append(doc_id)
    return [min((x for x in least[top(i)] if x is not None), default=None) for i in range(len(items))]


def test_fingerprints_and_groups_of_odd_texts(spark):
    rng = np.random.default_rng(5)
    words = [f"W{i}" for i in range(50)]
    texts = [*ODD, "A b", "a  B", *[" ".join(rng.choice(words, rng.integers(1, 60))) for _ in range(60)]]
    base = " ".join(rng.choice(words, 400))
    texts += [base, base + " w1", base.replace("W7", "w7"), "w0 " + base]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, base), (None, "lone words of none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fp": F.lit(1), "mask": F.lit(2), "a.b": F.lit(3)})
    got = simhash.near_duplicates(docs).select("doc_id", F.hex("fp"), "component_id").collect()
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    want = [(d, f"{f:X}", c) for (d, f), c in zip(prints, plain_groups(prints))]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert simhash.near_duplicates(docs.where("false")).collect() == []
    texts = simhash.near_duplicates(docs.select(F.concat(F.lit("id"), "doc_id").alias("doc_id"), "text"))
    assert dict(texts.dtypes)["component_id"] == "string" and texts.count() == len(rows)


def test_bit_sliced_pairs_equal_plain_distances():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**64, 900, dtype=np.uint64)
    for k in range(1, 3):
        part = slice(300 * k, 300 * (k + 1))
        fps[part] = fps[:300]
        for _ in range(3 * k):
            fps[part] ^= np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)
    apart = np.bitwise_count(fps[:, None] ^ fps[None, :])
    for radius in (0, 3, 4, 7):
        i, j = np.nonzero(np.triu(apart <= radius, 1))
        assert set(zip(i, j)) == set(zip(*simhash.pairs_within(fps, radius)))


def test_large_buckets_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 20)
    monkeypatch.setattr(simhash, "LEVELS", 2)
    rng = np.random.default_rng(9)
    near = np.full(400, 0x0123456789ABCDEF, np.uint64)
    for _ in range(5):
        near ^= np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)
    fps = np.unique(np.concatenate([near, rng.integers(0, 2**64, 300, dtype=np.uint64)]))
    frame = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    buckets = simhash._buckets(frame).collect()
    held = {}
    for r in buckets:
        held.setdefault((r["mask"], r["value"], r["deal"]), []).append(r["fp"])
    together = {(a, b) for own in held.values() for a in own for b in own if a < b}
    want = {(int(a), int(b)) for a in fps.view(np.int64) for b in fps.view(np.int64) if a < b and ((int(a) ^ int(b)) & simhash.ALL).bit_count() <= 4}
    assert want <= together and {r["deal"] for r in buckets} > {0}


# --- alignment


def plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(registry.model_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=registry.model_path())
    letters, told, counts = alignment._byte_alphabet(), [], Counter()
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ids_b)]
        if not text or {b"".join(raw_a), b"".join(raw_b)} != {(" " + text).encode()}:
            told.append((doc_id, 0, 0, 0, [], ""))
            continue
        ends = [np.cumsum([len(x) for x in raw]).tolist() for raw in (raw_a, raw_b)]
        spans = [list(zip([0, *e[:-1]], e)) for e in ends]
        links = []
        for i, (lo, hi) in zip(ids_a, spans[0]):
            first = bisect.bisect_right(ends[1], lo)
            links += [(i, ids_b[k]) for k in range(first, bisect.bisect_left(ends[1], hi) + 1)]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in common]
        for side, (ids, own) in enumerate(zip((ids_a, ids_b), ends)):
            for i, end in zip(ids, own):
                groups[bisect.bisect_left(common, end)][side].append(str(i))
        counts.update(links)
        told.append((doc_id, len(ids_a), len(ids_b), len(common), links, ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups)))
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    return [(d, na, nb, ng, len(ls), sum(counts[x] == top[x[1]] for x in ls), sum(counts[x] for x in ls), text) for d, na, nb, ng, ls, text in told], counts


def test_alignment_equals_a_plain_one(spark):
    texts = [t if t is None or len(t) < 2000 else "Word " * 300 for t in ODD]
    rows = [(f"d{i}", t) for i, t in enumerate(texts)] + [(None, "none's text"), ("d1", "a  b"), ("d1", "a  b")]
    docs = spark.createDataFrame(rows, "doc_id string, text string").withColumns({"run": F.lit(1), "pairs": F.lit(2), "a.b": F.lit(3)}).repartition(3)
    got, pairs = alignment.align(docs, registry.model_path("byte_bpe_50k.json"), registry.model_path())
    want, counts = plain_alignment(rows)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert {(r.a_id, r.b_id): r.n for r in pairs.collect()} == dict(counts)
    empty, none = alignment.align(docs.where("false"), registry.model_path("byte_bpe_50k.json"), registry.model_path())
    assert empty.collect() == [] and none.collect() == []


def test_alignment_of_the_given_table(spark, monkeypatch):
    monkeypatch.setattr(alignment, "WORDS", 700)  # most texts are taken in pieces
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = [tuple(r) for r in registry.op12_alignment(spark, "/root/testdata/sf0.001").collect()]
    want, _ = plain_alignment([(r.doc_id, r.text) for r in docs.collect()])
    digests = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in want]
    assert sorted(whole) == sorted(digests)
