"""Chosen-path join against trying all pairs, with every way a crowded node can take."""

import random
import re
from collections import defaultdict

import numpy as np

from tillbook.llm import chosenpath

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_version(rows, percent=85):
    sets, root = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (doc, _) in enumerate(rows):
        if sets[i] and doc is not None and (least[find(i)] is None or doc < least[find(i)]):
            least[find(i)] = doc
    own = [least[find(i)] if sets[i] else rows[i][0] for i in range(len(rows))]
    return sorted(((d, len(s), c, d == c) for (d, _), s, c in zip(rows, sets, own, strict=True)), key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in chosenpath.near_duplicates(df, **options).collect()), key=repr)


def family(rng, n, words, edits):
    """n copies of a text with up to ``edits`` words changed: similarities on both sides of the threshold."""
    base = [f"v{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(words)] = f"u{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


def made(seed):
    rng = random.Random(seed)
    texts = family(rng, 70, 160, 4) + family(rng, 40, 90, 6) + family(rng, 30, 400, 14)
    texts += [" ".join(f"z{rng.randrange(300)}" for _ in range(rng.randint(1, 60))) for _ in range(40)]
    texts += ["one two", "ONE  two", "one\ntwo three four", "", " \t\n", None, "a b c d e", "a b c d e a b c d e", "é 漢 x y z", "long " * 9000, " ".join(f"q{i}" for i in range(30_000))]
    texts += texts[:5]
    rows = list(enumerate(texts))
    return rows + [(None, texts[0]), (None, None), (None, "nobody has this text but one"), (3, texts[80]), (3, texts[80])]


ROWS = made(2)


def test_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = ROWS + [(r.doc_id + 1000, r.text) for r in docs]
    assert run(spark, rows) == plain_version(rows)


def test_blocks_pivots_and_functions_over_full_sets(spark):
    """Nodes of more than three sets are crowded."""
    assert run(spark, ROWS, small=3, levels=2) == plain_version(ROWS)


def test_weight_splits_nodes_and_all_pairs_of_blocks_settle_the_rest(spark, monkeypatch):
    monkeypatch.setattr(chosenpath, "WEIGHT", 300)
    assert run(spark, ROWS, levels=0) == plain_version(ROWS)


def test_shingles_of_pieces_and_blocks(monkeypatch):
    monkeypatch.setattr(chosenpath, "BYTES", 64)
    texts = [(t or "").encode() for _, t in ROWS]
    sets = [s for i in range(0, len(texts), 7) for s in chosenpath.shingle_sets(texts[i : i + 7], 5)]
    plain = [plain_set(t) for _, t in ROWS]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for i, j in [(0, 1), (0, 70), (75, 80), (140, 141), (180, 181), (180, 182)]:
        assert len(np.intersect1d(sets[i], sets[j])) == len(plain[i] & plain[j])


def test_trees_reach_the_recall():
    assert chosenpath.recall(0.85, chosenpath.TREES, chosenpath.DEPTH) >= chosenpath.RECALL > chosenpath.recall(0.85, chosenpath.TREES - 1, chosenpath.DEPTH)


def test_tokens_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(4)
    f = chosenpath._functions(chosenpath.COORDINATES)
    agree = []
    for _ in range(60):
        x = rng.integers(0, 2**64, 400, np.uint64)
        y = np.concatenate([x[:370], rng.integers(0, 2**64, 30, np.uint64)])  # similarity 370 / 430
        agree.append((chosenpath.signature(x, *f) == chosenpath.signature(y, *f)).mean())
    assert abs(np.mean(agree) - 370 / 430) < 0.02


def test_trees_meet_at_depth():
    """Measured share of pairs at the threshold that share a node of one tree at DEPTH, against ``recall``."""
    rng = np.random.default_rng(5)
    f, n = chosenpath._functions(chosenpath.COORDINATES), 1500
    pairs = []
    for _ in range(n):
        x = rng.integers(0, 2**64, 100, np.uint64)
        pairs.append((chosenpath.signature(x, *f), chosenpath.signature(np.concatenate([x[:92], rng.integers(0, 2**64, 8, np.uint64)]), *f)))  # 92 / 108
    values = np.array([v for p in pairs for v in p])

    def nodes(tree):
        rows = np.arange(2 * n)
        t, used, node = np.full(2 * n, tree), np.zeros(2 * n, np.int64), np.repeat(np.arange(n, dtype=np.uint64) + np.uint64(9), 2)
        for _ in range(chosenpath.DEPTH):
            at, used, node = chosenpath.children(t, used, node, values[rows], 85)
            rows, t = rows[at], t[at]
        found = defaultdict(set)
        for r, x in zip(rows.tolist(), node.tolist(), strict=True):
            found[r].add(x)
        return sum(bool(found[2 * k] & found[2 * k + 1]) for k in range(n)) / n

    share = np.mean([nodes(t) for t in range(4)])
    assert share >= chosenpath.recall(92 / 108, 1, chosenpath.DEPTH) - 0.02


def test_a_set_goes_to_its_cluster_once(spark, monkeypatch):
    """Alike sets below the threshold meet in most trees; the sets sent to be compared and the texts looked up stay in proportion to them."""
    rng, sent, texts = random.Random(6), [], []
    rows = list(enumerate([" ".join([f"c{k}_{w}" for w in range(100)] + [f"own{rng.randrange(10**9)}" for _ in range(22)]) for k in range(10) for _ in range(4)] + [" ".join(f"z{rng.randrange(10**9)}" for _ in range(50)) for _ in range(400)]))
    compare_groups, keep_one = chosenpath.compare_groups, chosenpath.keep_one

    def compared(near, *args):
        sent.append(near.count())
        return compare_groups(near, *args)

    def kept(df, keys, order):
        texts.extend([df.count()] * ("text" in df.columns))
        return keep_one(df, keys, order)

    monkeypatch.setattr(chosenpath, "compare_groups", compared)
    monkeypatch.setattr(chosenpath, "keep_one", kept)
    assert run(spark, rows) == plain_version(rows)
    assert 30 <= sum(sent) <= 40
    assert 30 <= sum(texts) <= 60


def test_every_leaf_is_one_of_its_tree(spark):
    """Leaves are the nodes at DEPTH that branching one level after the other gives."""
    texts = [(t or "").encode() for _, t in ROWS[:30]]
    f = chosenpath._functions(chosenpath.COORDINATES)
    values = np.array([chosenpath.signature(x, *f) for x in chosenpath.shingle_sets(texts, 5)])
    df = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(values)], "id long, sig binary")
    got = chosenpath.leaves(df, 85).collect()
    low = (1 << chosenpath.TREE_BITS) - 1
    assert {(r.node & low) for r in got} == set(range(chosenpath.TREES))
    for tree in (0, chosenpath.TREES - 1):
        rows, used, node = np.arange(30), np.zeros(30, np.int64), chosenpath.mix(np.full(30, tree + 1, np.uint64))
        for _ in range(chosenpath.DEPTH):
            at, used, node = chosenpath.children(np.full(len(rows), tree), used, node, values[rows], 85)
            rows = rows[at]
        want = sorted((int(r), int(n) >> chosenpath.TREE_BITS) for r, n in zip(rows, node, strict=True))
        assert sorted((r.id, (r.node % 2**64) >> chosenpath.TREE_BITS) for r in got if r.node & low == tree) == want
