"""Operators that SQL cannot express, against plain independent versions."""

import glob
import hashlib
import math
import random
import re
import tempfile
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark import TaskContext
from pyspark.sql import functions as F

import corpus_pipeline
from llm import edge
from tillbook.llm import components, decontaminate, extract, hmm, mixing, quality, queries, repeats, secrets, sharding, simhash, suffixes, urls
from tillbook.session import CLEANUP_CONF, stage

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


# --- SimHash -----------------------------------------------------------------


def plain_fingerprint(text):
    words = WORD.findall(text.translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    """prints: [(id, fp)] -> the smallest id reachable, by trying all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= 4:
                root[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (doc, _) in enumerate(prints):
        if doc is not None and (least[find(i)] is None or doc < least[find(i)]):
            least[find(i)] = doc
    return [least[find(i)] for i in range(len(prints))]


def test_simhash_against_all_pairs(spark, docs, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    prints = [(d, plain_fingerprint(t)) for d, t in texts.items()]
    want = plain_components(prints)
    assert got == {d: (f"{fp:016x}", c) for (d, fp), c in zip(prints, want)}
    assert len(set(want)) < len(want)


def near_prints(n=150, seed=3):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)] + [0, (1 << 64) - 1]
    out = set(centres)
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randint(1, 7)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("hot", [simhash.HOT_BUCKET, 1])
def test_simhash_classes_with_and_without_hot_buckets(spark, hot):
    """hot=1 sends every crowded bucket through the midpoints."""
    prints = list(enumerate(near_prints()))
    df = spark.createDataFrame([(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in prints], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.classes(df, hot=hot).collect()}
    want = plain_components(prints)
    assert [got[fp - (1 << 64) if fp >> 63 else fp] for _, fp in prints] == want


def test_keep_one_keeps_the_smallest_of_each_group(spark, docs):
    classes = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    kept = sorted(r.doc_id for r in simhash.keep_one(docs).collect())
    assert kept == sorted(set(classes.values()))
    twice = docs.unionByName(docs)
    assert sorted(r.doc_id for r in simhash.keep_one(twice).collect()) == kept


def test_stars_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 900), (900, 950)], "a long, b long")
    got = {r.a: r.b for r in components.stars(links).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000: 900, 950: 900}


# --- Suffix order and repeats ------------------------------------------------


def test_suffix_places_against_sorting(spark):
    rng = random.Random(5)
    base = [rng.randint(1, 3) for _ in range(60)]
    made = {}
    for i in range(40):
        at = rng.randint(0, 30)
        made[i] = [rng.randint(1, 3) for _ in range(rng.randint(0, 5))] + base[at : at + rng.randint(0, 50)] + [rng.randint(1, 4) for _ in range(rng.randint(0, 4))]
    df = spark.createDataFrame([(i, bytearray(np.array(v, np.int64).tobytes())) for i, v in made.items()], "sid long, names binary").repartition(4)
    got = Counter()
    for r in suffixes.places(df).collect():
        got[r.sid, r.j] += r.v
    order = sorted((v[j:] + [-i - 1], (i, j)) for i, v in made.items() for j in range(len(v)))
    assert dict(got) == {k: n for n, (_, k) in enumerate(order)}


def plain_repeats(body, length):
    seen = Counter(t[i : i + length] for t in body for i in range(len(t) - length + 1))
    out = []
    for t in body:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_texts(length, seed=1):
    """Passages around the length, shared in parts; low entropy; copies; edge rows."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé ") for _ in range(rng.randint(1, 6)))
    prose = lambda n: "".join(word() for _ in range(n))[:n]
    shared = [prose(rng.randint(length - 4, 3 * length)) for _ in range(12)]
    out = ["", None, "x" * (3 * length), "ab" * length, prose(9 * length)]
    for _ in range(60):
        t = prose(rng.randint(0, length))
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            t += s[a : a + rng.randint(length - 6, 3 * length)] + prose(rng.randint(0, length))
        out.append(t)
    return out + out[10:13] + out[10:11]


def test_repeats_against_all_strings(spark, tmp_path):
    length = 40
    body = repeat_texts(length)
    df = spark.createDataFrame([(None if i % 9 == 8 else i // 2, t, i) for i, t in enumerate(body)], "doc_id long, text string, row long")
    df.repartition(3).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(df, length=length).collect())
    want = sorted(plain_repeats([(t or "").encode() for t in body], length))
    assert got == want
    assert sum(w[1] > 0 for w in want) > 30


def test_marks_agree_in_copies():
    rng = random.Random(2)
    scale = repeats.Scale()
    s = bytes(rng.choice(b"abc ") for _ in range(400))
    a, b = bytes(rng.choice(b"abc ") for _ in range(300)) + s, s + bytes(rng.choice(b"abc ") for _ in range(300))
    ma, mb = (repeats.marks(repeats.Digests(x), scale.gram, scale.window) for x in (a, b))
    inside = [m - 300 for m in ma if 300 + scale.window <= m <= 700 - scale.settle]
    assert inside == [m for m in mb if scale.window <= m <= 400 - scale.settle] and inside


# --- Secrets -----------------------------------------------------------------


def plain_spans(text):
    found = []
    for m in re.finditer(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m.group(2)) >= 8:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found)


def test_base_spans_against_plain_patterns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    rows = secrets.scan(docs).collect()
    for r in rows:
        want = plain_spans(texts[r.doc_id])
        line = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for _, k, _ in want) for kind in range(3))
        assert [s for s in r.spans.split(",") if s and not s.startswith("markov")] == line.split(",") * bool(line)
    assert sum(r.n_assign + r.n_access + r.n_hex for r in rows) > 0


def test_offsets_are_code_points(spark):
    text = "é漢 api_key = 'abcdefgh1' ſecret=abcdefghij tokeN:12345678 AKIAAKIA"
    assert secrets.base_spans(text.encode())
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    row = secrets.scan(df).first()
    want = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(text))
    assert row.spans == want and row.n_assign == 2


def test_markov_models_on_held_out_strings(spark, texts):
    """Trained on planted secrets, the models tell new random strings from identifiers and words."""
    rng = random.Random(4)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    plant = lambda: "".join(rng.choice(chars) for _ in range(32))
    body = [t + f'\npassword="{plant()}"' for t in texts.values()]
    df = spark.createDataFrame(list(enumerate(body)), "doc_id long, text string")
    model = secrets.train(df)
    random_runs = [plant().encode() for _ in range(300)]
    words = [w.encode() for t in texts.values() for w in re.findall(r"[A-Za-z]{5,}", t)]
    plain_runs = ["_".join(w.decode() for w in rng.sample(words, 3)).encode() + b"_2024" for _ in range(300)]
    right = sum(secrets.ratio(r, model) > secrets.MIN_RATIO for r in random_runs) + sum(secrets.ratio(r, model) <= secrets.MIN_RATIO for r in plain_runs)
    assert right >= 0.97 * 600
    found = secrets.all_spans(b"see " + random_runs[0] + b" there", model)
    assert found == [(4, 3, 36)]


# --- Decontamination, quality ------------------------------------------------


def test_hit_spans_point_into_the_original():
    text = "Über—One, TWO  three\n四 five!"
    auto = decontaminate.build_automaton([("7", "one two".encode()), ("8", "四 FIVE".encode())])
    words = decontaminate.words_of(text.encode())
    hit, found = decontaminate.find_hits(words, auto)
    assert found == ["8"]  # "—" belongs to a word, so "one" is no word of its own
    assert [text[a:b] for a, b in decontaminate.hit_spans(text.encode(), hit)] == ["四 five"]


def test_benchmark_over_the_bound_is_refused(spark):
    with pytest.raises(ValueError):
        decontaminate.benchmark_items(spark.createDataFrame([(1, "abc")], "item_id int, text string"), limit=2)


def plain_quality(text):
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    n = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
    return n, len(words) < 10 or 100 * len(covered) > 20 * len(words)


def test_base_counts_against_plain_code(texts):
    for t in [*texts.values(), *(r[1] or "" for r in edge.TEXTS), "a b c d e " * 3, "x\u00a0y \x1c z\x85"]:
        *got, _ = quality.base_counts(t.encode())
        want, failed = plain_quality(t)
        assert tuple(got) == want and quality.fails_base(got[0], got[4]) == failed


def test_quality_keeps_good_and_rejects_junk(spark, docs):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = {r.doc_id: r for r in quality.quality(docs).collect()}
    good = [rows[d] for d, q in labels.items() if q == 1 and not rows[d].base_failed]
    junk = [rows[d] for d, q in labels.items() if q == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(r.kept for r in junk) <= 0.2 * len(junk)
    assert all(not (r.base_failed and r.kept) for r in rows.values())
    assert sorted(r.doc_id for r in quality.keep_good(docs).collect()) == sorted(d for d, r in rows.items() if r.kept)


def test_short_junk_is_judged_by_its_characters(spark, docs):
    junk = "%%% *** ### win@@ $$$ 777 && <<< " * 7
    junk = " ".join(f"{w}{i}" for i, w in enumerate(junk.split()[:40]))  # no word twice, so the base rules pass
    row = quality.quality(docs.select("doc_id", "text", "lang").union(spark.createDataFrame([(-1, junk, "en")], "a bigint, b string, c string"))).where("doc_id = -1").first()
    assert 200 <= len(junk) < 400 and not row.base_failed and row.word_distance is None
    assert row.class_distance > quality.MAX_CLASS_DISTANCE and not row.kept


def test_a_rare_language_has_its_reference(spark, docs):
    more = [(-1, " ".join(f"zo{chr(97 + i % 26)}ra{i}" for i in range(60)), "zz"), (-2, " ".join(f"鮪{i}鯨" for i in range(60)), "yy"), (-3, "", "ww")]
    mixed = docs.select("doc_id", "text", "lang").union(spark.createDataFrame(more, "a bigint, b string, c string"))
    rows = {r.doc_id: r for r in quality.quality(mixed).collect()}
    assert len(rows) == docs.count() + 3 and rows[-1].kept and rows[-2].kept and not rows[-3].kept
    assert sorted(r.doc_id for r in quality.keep_good(mixed).collect()) == sorted(d for d, r in rows.items() if r.kept)


def test_js_distance():
    refs = np.array([[0.5, 0.5, 0.0], [0.0, 0.0, 1.0]])
    assert np.allclose(quality.js_distance(np.array([2, 2, 0]), refs), [0, 1])


# --- Mixing, sharding, URLs --------------------------------------------------


def test_targets_by_repeated_sharing(spark):
    sizes = {None: 50, "a": 10, "b": 400, "c": 0, "d": 1000}
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, free, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while True:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            want |= {s: left * weight[s] / total for s in free}
            break
        want |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    assert got == pytest.approx(want)


def test_mix_comes_near_its_targets_and_agrees_with_the_query(spark, docs, texts):
    rows = queries.QUERIES["op8_source_mixing"](spark, SF).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    taken, largest, target = Counter(), Counter(), {}
    for r in rows:
        assert r.size == len(WORD.findall(texts[r.doc_id])) and 0 <= r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
        largest[source[r.doc_id]] = max(largest[source[r.doc_id]], r.size)
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - target[s]) <= 2 * largest[s] for s in target)
    copies = Counter(r.doc_id for r in mixing.mix(docs).collect())
    assert copies == Counter({r.doc_id: r.taken // r.size for r in rows if r.size and r.taken})


def test_shards_are_even_and_slots_gapless(spark, docs):
    rows = sharding.shard(docs.select("doc_id", "text"), shards=8).collect()
    size = Counter()
    for r in rows:
        size[r.shard] += len((r.text or "").encode()) + 1
    worst = max(len((r.text or "").encode()) + 1 for r in rows)
    mean = sum(size.values()) / 8
    assert all(abs(size[s] - mean) <= worst + 0.02 * mean for s in range(8))
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_a_group_larger_than_a_shard_is_split_and_small_ones_are_not(spark):
    rows = [(i, "same text") for i in range(3000)] + [(10_000 + i, f"text {i // 2:05d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.assignment(df).collect()
    size, shards = Counter(), defaultdict(set)
    for r in found:
        size[r.shard] += r.size
        shards[r.text_crc32].add(r.shard)
    assert max(size.values()) <= 1.03 * sum(size.values()) / 16
    assert len(shards[zlib.crc32(b"same text")]) >= 8 and sum(len(s) > 1 for s in shards.values()) == 1


def test_cascade_is_exact_over_many_levels(spark):
    keys = spark.range(6000).selectExpr("concat('h', id, '.example.com') AS key", "id % 7 = 0 AS listed")
    levels = urls.cascade(keys)
    assert len(levels) > 2
    assert keys.where(urls.listed(levels, keys["key"]) != keys["listed"]).count() == 0
    nothing = urls.cascade(keys.withColumn("listed", keys["listed"] & (keys["key"] == "")))
    assert nothing == [] and keys.where(urls.listed(nothing, keys["key"])).count() == 0
    everything = keys.selectExpr("key", "true AS listed")
    assert everything.where(urls.listed(urls.cascade(everything), everything["key"])).count() == 6000


# --- Extraction --------------------------------------------------------------


@pytest.fixture(scope="module")
def labeller(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()]
    return pages, extract.train(pages[:100], made=200)


def test_extraction_on_held_out_pages(labeller):
    pages, model = labeller
    rest = pages[100:]
    for page, text in zip(rest, extract.extract(rest, model, extract.Vectors()), strict=True):
        inner = re.search(r"(?s)<article>(.*?)</article>", page).group(1)
        parts = [" ".join(extract.html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inner)]
        assert text == "\n".join(x for x in parts if x)


def test_labeller_on_held_out_layouts(labeller):
    pages, model = labeller
    rng, vectors = np.random.default_rng(123), extract.Vectors()
    paragraphs = [b.text for p in pages[100:130] for b in extract.blocks(p)]
    wrong = total = 0
    for _ in range(150):
        found, labels = extract.made_up(paragraphs, rng)
        got = model.label(vectors.pages([found]))[0]
        wrong, total = wrong + int((got != labels).sum()), total + len(labels)
    assert wrong <= 0.08 * total


def test_blocks_of_broken_html():
    found = [b.text for b in extract.blocks("<p>a  b<br>c &amp; d<p><b>e<i>f</b> g<script>x<p>y</script>h<!-- n --> i</div>j<td>k < l <3 &#x41;")]
    assert found == ["a b", "c & d", "ef gh i", "j", "k < l <3 A"]


def test_lstm_gradients():
    rng = np.random.default_rng(0)
    model = extract.BiLstm(3, 4)
    model.params = {k: v.astype(np.float64) for k, v in model.params.items()}
    x, mask = rng.standard_normal((2, 5, 3)), np.array([[True] * 5, [True] * 3 + [False] * 2])
    y = rng.integers(0, 2, (2, 5)).astype(float)
    _, grads = model.gradients(x, mask, y)
    for name in model.params:
        at = tuple(int(rng.integers(n)) for n in model.params[name].shape)
        keep = model.params[name][at]
        losses = []
        for step in (1e-3, -1e-3):
            model.params[name][at] = keep + step
            losses.append(model.gradients(x, mask, y)[0])
        model.params[name][at] = keep
        assert grads[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-3, rel=0.05, abs=2e-4)


# --- LM scoring --------------------------------------------------------------


def test_forward_and_counts_against_enumeration(monkeypatch):
    monkeypatch.setattr(hmm, "STATES", 2)
    rng = np.random.default_rng(1)
    norm = lambda a: a / a.sum(axis=-1, keepdims=True)
    model = hmm.Hmm(norm(rng.random(2)), norm(rng.random((2, 2))), norm(rng.random((2, 3))))
    sequences = [np.array(s) for s in ([0, 1, 2, 1], [2], [1, 0])]
    likelihoods, start, move, emit = [], np.zeros(2), np.zeros((2, 2)), np.zeros((2, 3))
    for s in sequences:
        paths = {}
        for code in range(2 ** len(s)):
            z = [code >> k & 1 for k in range(len(s))]
            p = model.start[z[0]] * model.emit[z[0], s[0]]
            for a, b, o in zip(z, z[1:], s[1:]):
                p *= model.move[a, b] * model.emit[b, o]
            paths[tuple(z)] = p
        total = sum(paths.values())
        likelihoods.append(math.log10(total))
        for z, p in paths.items():
            start[z[0]] += p / total
            for a, b in zip(z, z[1:]):
                move[a, b] += p / total
            for k, o in zip(z, s):
                emit[k, o] += p / total
    assert hmm.log10_likelihoods(model, sequences) == pytest.approx(likelihoods)
    got = hmm.split_counts(hmm.expected_counts(model, sequences), 3)
    for a, b in zip(got, (start, move, emit)):
        assert np.allclose(a, b, atol=1e-5)


def test_scores(spark, monkeypatch, docs, texts):
    monkeypatch.setattr(hmm, "DICTIONARY", 10_000)  # so that some words are found by the join
    rows = hmm.score(docs).collect()
    train = [t for d, t in texts.items() if zlib.crc32(str(d).encode()) % 10]
    counts = Counter(w for t in train for w in [*WORD.findall(t.translate(LOWER)), ""])
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        tokens = [*WORD.findall(texts[r.doc_id].translate(LOWER)), ""]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_symbol_probabilities_sum_to_one(spark, docs):
    """Every state spreads one over the symbols, every class one over its known words and one unseen."""
    train = docs.where("doc_id % 3 > 0")
    lex, counts = hmm.lexicon(train)
    unigram = lex.symbol_counts()
    model = hmm.Hmm.from_counts(np.ones(hmm.STATES + hmm.STATES**2 + hmm.STATES * len(unigram)), unigram)
    assert np.allclose(model.emit.sum(axis=1), 1) and np.allclose(model.move.sum(axis=1), 1)
    rare = [r for r in counts.orderBy("c").limit(50).collect() if bytes(r.word)]
    assert all((r.c + hmm.SMOOTH) / lex.class_size[hmm.ending(bytes(r.word))] <= 1 for r in rare)


def test_every_round_runs_in_tasks(spark, monkeypatch, docs):
    counts = hmm.expected_counts

    def in_task(*a):
        assert TaskContext.get() is not None
        return counts(*a)

    monkeypatch.setattr(hmm, "expected_counts", in_task)
    train = docs.select("doc_id", F.lit(False).alias("held_out"), "text")
    rounds, run = [], hmm.one_round
    monkeypatch.setattr(hmm, "one_round", lambda *a: rounds.append(1) or run(*a))
    lex, words = hmm.lexicon(train)
    hmm.train(stage(hmm.encode(train, lex)), lex, words)
    assert len(rounds) == hmm.ROUNDS


def test_every_training_word_has_emissions_of_its_own(spark, monkeypatch, docs):
    """In the dictionary or by the join: the same scores, and each word's expected counts add up to its count."""
    whole = {r.doc_id: r.score for r in hmm.score(docs).collect()}
    monkeypatch.setattr(hmm, "DICTIONARY", 9_000)
    assert {r.doc_id: r.score for r in hmm.score(docs).collect()} == pytest.approx(whole, rel=1e-3)
    train = docs.select("doc_id", F.lit(False).alias("held_out"), "text")
    lex, counts = hmm.lexicon(train)
    _, table = hmm.train(stage(hmm.encode(train, lex)), lex, counts)
    rows = {bytes(r.word): r for r in table.collect()}
    times = {bytes(r.word): r.c for r in counts.collect()}
    assert len(rows) > 1000 and set(rows) == set(times) - set(lex.index()) - {b""}
    assert all(r.c == times[w] == pytest.approx(sum(r[e] for e in hmm.SUMS), rel=1e-4) for w, r in rows.items())
    lean = Counter((hmm.ending(w), max(hmm.SUMS, key=lambda e: r[e])) for w, r in rows.items())
    assert len(lean) > len({g for g, _ in lean})  # words of one ending lean to several states


def test_other_words_travel_packed(spark, monkeypatch, docs):
    """Blocks and buckets exchange one row for each pair of them, not one for each word; numbers come back as they were."""
    monkeypatch.setattr(hmm, "DICTIONARY", 9_000)
    monkeypatch.setattr(hmm, "BUCKET", 1_000)
    rows = docs.select("doc_id", (F.col("doc_id") % 10 == 0).alias("held_out"), "text")
    lex, _ = hmm.lexicon(rows.where("not held_out"))
    blocks = stage(hmm.encode(rows, lex))
    _, told = hmm.learn(blocks, lex, 1)
    assert lex.buckets > 1 and 0 < told.count() <= blocks.count() * lex.buckets
    for r in blocks.collect():
        new = [bytes(w) for w in r.others]
        assert len(set(new)) == len(new) and [zlib.crc32(w) % lex.buckets for w in new] == [b for b, n in enumerate(np.diff(r.cuts)) for _ in range(n)]
    for a in (np.array([1, 2**20, 2**31 - 1], "<i4"), np.array([], "<f4"), np.array([[0.5, 2.0**-20]], "<f8")):
        assert np.array_equal(hmm.unpacked(hmm.packed(a), a.dtype.str), a.reshape(-1))


def test_stage_leaves_no_shuffle_files(spark):
    files = lambda: {f for f in glob.glob(f"{tempfile.gettempdir()}/blockmgr-*/*/shuffle_*")}
    before, conf = files(), spark.conf.get(CLEANUP_CONF)
    assert stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()).count() == 7
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    # The last count's own file may be left, which has one row a partition.
    assert len([f for f in files() - before if f.endswith(".data")]) <= 1 and spark.conf.get(CLEANUP_CONF) == conf


# --- Pipeline ----------------------------------------------------------------


def test_pipeline_stages_against_their_operators(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_dedup", "benchmark_decontamination", "source_mix", "sharding"]
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        step(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = ids(docs)
        if name == "quality_rules":
            assert kept[name] == ids(quality.quality(before).where("kept"))
        if name == "simhash_dedup":
            rows = [(r.doc_id, plain_fingerprint(r.text or "")) for r in before.collect()]
            assert kept[name] == Counter(set(plain_components(rows)))
        if name == "benchmark_decontamination":
            bad = decontaminate.contamination(before, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated")
            assert kept[name] == ids(before) - ids(bad) and ids(bad)
        if name == "sharding":
            assert kept[name] == kept["source_mix"] and docs.columns == [*before.columns, "shard", "slot"]
