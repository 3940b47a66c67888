"""Near duplicates, repeats, recurring lines, fingerprints, beside brute force."""

import hashlib
import itertools
import random
import re
import struct
import tracemalloc
from collections import Counter

import messy
import numpy as np
import pytest
import regex
import xxhash
from cellferry.llm import components, fingerprints, jaccard, lattice, repeats, templates
from pyspark.sql import functions as F

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text, n=5):
    w = WORD.findall(text.encode().translate(LOWER))
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def roots(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    return {n: top(n) for n in nodes}


def brute_jaccard(texts):
    sets = [(i, shingles(t)) for i, t in texts]
    links = [
        (a, b)
        for (a, x), (b, y) in itertools.combinations([s for s in sets if s[0] is not None and s[1]], 2)
        if a != b and 100 * len(x & y) >= 80 * len(x | y)
    ]
    top = roots({i for i, _ in texts if i is not None}, links)
    return Counter((i, len(s), top.get(i)) for i, s in sets)


def variants(seed, groups=12, copies=9):
    """Groups of texts of many lengths around the similarity that counts."""
    rng, out = random.Random(seed), []
    for g in range(groups):
        size = rng.choice([1, 3, 4, 5, 6, 8, 9, 12, 20, 40, 90, 300])
        base = [f"{g}x{rng.randrange(10 * size)}" for _ in range(size)]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(1 + size // 20 + 1)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                w += [f"n{rng.randrange(10**6)}" for _ in range(rng.randrange(1 + size // 4))]
            out.append((len(out) * 3 + 1, " ".join(w)))
    rng.shuffle(out)
    return out


def groups_of(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(df).collect())


def test_jaccard_on_messy_rows(docs):
    assert groups_of(docs) == brute_jaccard(messy.texts_of(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_loses_no_link(spark, seed, monkeypatch):
    texts = variants(seed)
    monkeypatch.setattr(jaccard, "POSTING_SLICE", 4000)  # keys meet across slices
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert groups_of(df) == brute_jaccard(texts)


def test_linked_sets_share_a_posting():
    rng = np.random.default_rng(3)
    for size in [*range(1, 60), 100, 333, 1000]:
        for _ in range(12):
            base = rng.integers(1, 1 << 62, size, dtype=np.uint64)
            gone = int(rng.integers(0, size // 5 + 1))
            added = int(rng.integers(0, max(0, (size - gone) * 5 // 4 - size) + 1))
            other = np.concatenate([base[gone:], rng.integers(1, 1 << 62, added, dtype=np.uint64)])
            if 100 * (size - gone) >= 80 * (size + added):
                x, y = np.unique(base), np.unique(other)
                assert np.intersect1d(jaccard.postings(x, 80), jaccard.postings(y, 80)).size, (size, gone, added)
                fits = jaccard.possible(len(x), jaccard.parity(x), [(len(y), jaccard.parity(y))], 80)
                assert fits.all()


def test_keys_of_many_rows_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 4)
    rows = [(1, i, i) for i in range(13)] + [(2, 20, 20), (2, 21, 21)]
    sketch = jaccard.parity(np.arange(1, 40, dtype=np.uint64)).tobytes()
    df = spark.createDataFrame(rows, "key long, rep long, component long").withColumns({"n": F.lit(39), "sketch": F.lit(sketch)})
    got = sorted((r.a, r.b) for r in jaccard.across(jaccard.tiled(df), 80).distinct().collect())
    assert got == sorted([*itertools.combinations(range(13), 2), (20, 21)])


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(500, 500), (7, 100_000), (700, 600)]
    rng.shuffle(links)
    df = spark.createDataFrame([*links, (None, 3)], "x long, y long").repartition(3)
    got = {r.node: r.component for r in components.components(df).collect()}
    want = roots({n for e in links for n in e}, links)
    assert got == {n: c for n, c in want.items() if n != 500}
    assert components.components(df.limit(0)).count() == 0


def brute_vectors(rows, least=0.9):
    good = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
    ]
    links = [
        (a, b)
        for (a, x), (b, y) in itertools.combinations(good, 2)
        if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least
    ]
    top, n = roots({i for i, _ in rows if i is not None}, links), Counter()
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return {i: (n[i], top[i], top[i] == i) for i, _ in rows if i is not None}


def clustered(seed, clusters=8, each=14, dimensions=64):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(clusters):
        centre = rng.standard_normal(dimensions)
        out += [centre + rng.standard_normal(dimensions) * rng.choice([0, 0.05, 0.1, 0.2]) for _ in range(each)]
    return [(i, [float(x) for x in v]) for i, v in enumerate(out)]


SHAPE = "vec_id long, embedding array<double>, label int"


def test_vectors_by_cosine(spark, monkeypatch):
    odd = [(900, None), (901, []), (902, [0.0] * 64), (903, [None] + [1.0] * 63), (904, [float("nan")] * 64), (905, [1.0, 2.0])]
    odd += [(906, [float("inf")] * 64), (907, [2.0, 4.0]), (None, [1.0] * 64)]
    for tile in (4000, 6):
        monkeypatch.setattr(lattice, "TILE", tile)
        rows = clustered(tile) + odd
        df = spark.createDataFrame([(i, v, 1) for i, v in rows], SHAPE).repartition(3)
        made = lattice.near_vectors(df, tables=8).collect()
        assert len(made) == len(rows)
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in made}
        assert got.pop(None) == (0, None, False)
        assert got == brute_vectors(rows)
    assert lattice.near_vectors(df.limit(0)).count() == 0


def test_vectors_that_share_an_id(spark):
    near = np.random.default_rng(4).standard_normal(64)
    vectors = [near + 0.05 * np.random.default_rng(i).standard_normal(64) for i in range(3)]
    far = [-near, -near + 0.05 * np.random.default_rng(9).standard_normal(64)]
    rows = [(5, vectors[0]), (5, far[0]), (1, vectors[1]), (2, vectors[2]), (8, far[1]), (8, far[1]), (9, np.eye(64)[0])]
    df = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in rows], SHAPE).repartition(3)
    df = df.selectExpr("*", "vec_id as id", "label as rep", "'x' as h1")
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.near_vectors(df, tables=8).collect())
    # one row of id 5 is linked with 1 and 2, the other one with both rows of id 8, which are copies
    assert got == Counter({(5, 2, 1, False): 2, (1, 2, 1, True): 1, (2, 2, 1, False): 1, (8, 2, 1, False): 2, (9, 0, 9, True): 1})


def test_recall_at_the_threshold():
    rng = np.random.default_rng(3)
    u = lattice.units(rng.standard_normal((3000, 64)))
    for cosine in (0.9, 0.93, 0.97):
        v = rng.standard_normal((3000, 64))
        v -= (v * u).sum(1)[:, None] * u
        w = cosine * u + np.sqrt(1 - cosine**2) * lattice.units(v)
        cells = lattice.Tables(64, 4, 8, 1.4).cells(np.concatenate([u, w]))
        assert (lattice.first_shared(*cells, np.arange(3000), np.arange(3000) + 3000) > 0).mean() > 0.97


def test_decoding_gives_the_nearest_lattice_point():
    x = np.random.default_rng(1).standard_normal((500, 8)) * 2
    point = lattice.nearest_e8(x)
    whole = (point == np.rint(point)).all(1)
    assert (whole | (point - 0.5 == np.rint(point - 0.5)).all(1)).all() and (point.sum(1) % 2 == 0).all()
    near = ((x - point) ** 2).sum(1)
    for v in lattice.NEIGHBOURS:
        assert (near <= ((x - point - v) ** 2).sum(1) + 1e-9).all()


def brute_repeats(texts, length=100):
    first, out = {}, {}
    order = sorted({(i is None, i or 0, t) for i, t in texts}, key=lambda k: k[:2])
    for missing, i, text in order:
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            if s in first:
                gone[p : p + length] = True
            else:
                first[s] = 1
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[None if missing else i, text] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return Counter((i, *out[i, t]) for i, t in texts)


def removed(df, length=100):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.without_repeats(df, length).collect())


def test_repeats_on_messy_rows(docs):
    assert removed(docs) == brute_repeats(messy.texts_of(docs))


@pytest.mark.parametrize("length, slice_bytes", [(100, 4 << 20), (100, 3000), (60, 2000)])
def test_repeats_of_edited_and_periodic_texts(spark, monkeypatch, length, slice_bytes):
    monkeypatch.setattr(repeats, "SLICE", slice_bytes)
    rng = random.Random(length + slice_bytes)
    passages = [messy.words(k, 60) for k in range(4)]
    texts = []
    for i in range(40):
        t = " ".join([messy.words(50 + i, rng.randrange(80)), rng.choice(passages), messy.words(90 + i, rng.randrange(60))])
        if rng.random() < 0.4 and texts:
            t = list(rng.choice(texts)[1])
            for _ in range(rng.randrange(4)):
                t[rng.randrange(len(t))] = rng.choice("qéz")
            t = "".join(t)
        texts.append((i * 2, t))
    texts += [(1001, "é" * 300), (1000, "ab" * 300), (1003, "ab" * 90 + "c" * 200), (1005, "x" * length), (1007, "x" * (length - 1))]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert removed(df, length) == brute_repeats(texts, length)


def test_a_passage_of_many_texts_takes_nothing_beside_it(spark):
    rng = random.Random(7)
    passage = messy.words(1, 60)[:150]
    texts = [(i, f"{rng.getrandbits(200):050x} {passage} {rng.getrandbits(200):050x}") for i in range(9000)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert removed(df) == brute_repeats(texts)


def test_kept_text_carries_columns(spark):
    text = messy.words(1, 60)
    df = spark.createDataFrame([(1, text, "a"), (2, "new start " + text + " end", "b")], "doc_id long, text string, source string")
    made = {r.doc_id: r for r in repeats.without_repeats(df, carry=("source",)).collect()}
    assert made[1].kept_text == text and made[2].kept_text == "new start  end" and made[2].source == "b"


def test_recurring_templates_keep_their_first_line(spark):
    own = [f"{x} is the own first {x} line {x} of this {x} text" for x in "uvwxyz"]
    texts = [(i, "\n".join([own[i], f"Copyright {2000 + i} by the authors , all rights", "Yes.", f"page of the book {'abcdef'[i]} in the same library today"])) for i in range(6)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    made = {r.doc_id: r for r in templates.recurring_lines(df).collect()}
    assert made[0].kept_text == texts[0][1] and made[0].n_dropped == 0
    for i in range(1, 6):
        lines = made[i].kept_text.split("\n")
        assert not any(x.startswith(("Copyright", "Yes.", "page")) for x in lines) and made[i].n_lines == 4
    two = templates.recurring_lines(df.where("doc_id < 2"))
    assert all(r.n_dropped == 0 for r in two.collect())


def brute_exact(texts, documents=3):
    """Kept lines, where no two templates are alike enough to be one."""

    def template(line):
        tokens = "".join(f" {c} " if "\u4e00" <= c <= "\u9fff" else c for c in line).split()
        masked = [re.sub(r".*[0-9].*", "<*>", t) for t in tokens]
        return tuple(tokens if set(masked) == {"<*>"} else masked)

    there, first = {}, {}
    for i, text in sorted(texts):
        for k, line in enumerate(text.split("\n")):
            if template(line):
                there.setdefault(template(line), set()).add(text)
                first.setdefault(template(line), (i, k))
    return {
        i: "\n".join(
            line
            for k, line in enumerate(text.split("\n"))
            if not template(line) or len(there[template(line)]) < documents or first[template(line)] == (i, k)
        )
        for i, text in texts
    }


def test_short_unspaced_and_numeric_lines_like_brute_force(spark):
    lines = ["Read more", "Subscribe", "阅读全文", "第 7 页", "第8页", "No. 12", "No. 13", "12", "13", "12 13", "", " ", "a\tb", "x9", "你好吗"]
    rng = random.Random(5)
    texts = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 6)))) for i in range(60)]
    made = templates.recurring_lines(spark.createDataFrame(texts, "doc_id long, text string").repartition(3))
    assert {r.doc_id: r.kept_text for r in made.collect()} == brute_exact(texts)


def test_a_leaf_has_as_many_templates_as_it_needs(spark):
    one, two = "read more about the weather in {} and all around", "read more about our new offers for {} until friday"
    texts = [(i, "\n".join([f"text {'abcdefgh'[i]} has its own line", (two if i % 2 else one).format("stuvwxyz"[i])])) for i in range(8)]
    made = {r.doc_id: r for r in templates.recurring_lines(spark.createDataFrame(texts, "doc_id long, text string").repartition(2)).collect()}
    kept = [line for r in made.values() for line in r.kept_text.split("\n") if line.startswith("read")]
    assert sorted(kept) == sorted([one.format("s"), two.format("t")])


def test_lines_on_messy_rows(docs, none):
    made = templates.recurring_lines(docs)
    assert made.columns == [*docs.columns, "n_lines", "n_dropped", "kept_text"]
    rows = made.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in docs.collect())
    for r in rows:
        lines = [] if r.text is None else r.text.split("\n")
        left = [] if r.kept_text is None else r.kept_text.split("\n")
        assert r.n_lines == len(lines) and (r.kept_text is None) == (r.text is None)
        assert r.n_dropped == len(lines) - (len(left) if r.n_dropped < len(lines) else 0)
    assert templates.recurring_lines(none).count() == 0


def edited(texts):
    order = sorted({(i is None, -(i or 0)) for i, _ in texts})
    assert order
    return order


def test_fingerprints_on_messy_rows(docs, none):
    made = fingerprints.edited_fingerprints(docs).collect()
    assert len(made) == docs.count()
    by_text = {}
    for r, n in ((r, r.n_chars) for r in made):
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text.setdefault((r.doc_id, n), set()).add(r.fingerprint)
    assert all(len(v) == 1 for k, v in by_text.items() if k[0] != 10)
    assert fingerprints.edited_fingerprints(none).count() == 0


def test_edited_texts_take_the_next_one(spark):
    rng = random.Random(4)
    ids = rng.sample(range(-500, 10**9), 300)
    texts = sorted(((i, messy.words(i, rng.randrange(60)).replace(" w1", ".\nw1")) for i in ids), reverse=True)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(df).collect()}
    for k, (i, t) in enumerate(texts):
        half = len(t) // 2
        want = t[: len(t) - half] + texts[(k + 1) % len(texts)][1][:half]
        assert got[i].edited_sha256 == hashlib.sha256(want.encode()).hexdigest() and got[i].n_chars == len(t)
        assert (got[i].near_edited == 1.0) == (got[i].fingerprint == got[i].edited_fingerprint)
    long = [r for i, r in got.items() if r.n_chars > 120]
    assert np.mean([r.near_edited for r in long]) > 0.3 + np.mean([r.near_next for r in long])


def plain_fingerprint(text):
    """The lanes, one after the other, in whole numbers of Python."""
    def hashed(seed, value):
        return xxhash.xxh64(value.encode(), seed=xxhash.xxh64(struct.pack("<i", seed), seed=42).intdigest()).intdigest()

    paragraphs = text.split("\n") if text else []
    runs = regex.findall(fingerprints.RUN, text)
    lanes = [sum(hashed(k, p) % 2**62 for p in paragraphs) % 2**62 for k in range(fingerprints.EXACT)]
    for seed in (100, 101):
        for shift in range(fingerprints.SHIFTS):
            low, high = (sum(hashed(seed, r) >> shift + place & 1 for r in runs) % 2**30 for place in (0, 31))
            lanes.append(low + (high << 31))
    return [*lanes, len(runs) % 2**30]


def plain_likeness(a, b):
    def signs(f):
        wide = f[fingerprints.EXACT : -1]
        return np.array([2 * (x >> place) % 2**31 - f[-1] if place else 2 * (x % 2**30) - f[-1] for x in wide for place in (0, 31)], float)

    x, y = signs(a), signs(b)
    norm = np.linalg.norm(x) * np.linalg.norm(y)
    return 1.0 if a == b else min(1.0, max(0.0, x @ y / norm)) if norm else 0.0


def test_fingerprints_and_likeness_by_hand(spark):
    rng = random.Random(8)
    signs = [" ", " ", ", ", ".\n", "\n\n", "。", "; "]
    texts = ["", "a", "\n", "one two three four five six", "日本語のテキスト", "word " * 3000, messy.words(2, 9000)]
    texts += ["".join(f"w{rng.randrange(40)}" + rng.choice(signs) for _ in range(rng.randrange(90))) for _ in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    half = [(t, len(t) // 2) for t in texts]
    for r in fingerprints.edited_fingerprints(df).collect():
        t, n = half[r.doc_id]
        after = texts[(r.doc_id - 1) % len(texts)]
        own, edited, following = map(plain_fingerprint, (t, t[: len(t) - n] + after[:n], after))
        assert r.fingerprint == "".join(f"{x:016X}" for x in own) and r.edited_fingerprint == "".join(f"{x:016X}" for x in edited)
        assert abs(r.near_edited - plain_likeness(own, edited)) < 1e-9 and abs(r.near_next - plain_likeness(own, following)) < 1e-9


def test_fingerprints_of_a_text_of_megabytes(spark):
    df = spark.createDataFrame([(1, messy.words(3, 400_000, 10**6)), (2, "short")], "doc_id long, text string")
    one = {r.doc_id: r for r in fingerprints.edited_fingerprints(df).collect()}
    assert one[1].n_chars > 2_000_000 and 0.6 < one[1].near_edited < 0.85 and one[1].near_next < 0.2


def test_likeness_needs_no_punctuation(spark):
    rng = random.Random(11)
    texts = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(120))) for i in range(60)]
    texts += [(100 + i, "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(200)) + "。") for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    for r in fingerprints.edited_fingerprints(df).collect():
        assert r.near_edited > r.near_next, r.doc_id


def test_likeness_counts_more_than_a_million_runs(spark):
    one = fingerprints.fingerprint(F.col("t"))
    most = F.transform(F.slice(one, fingerprints.EXACT + 1, fingerprints.WIDE + 1), lambda x: x * (1 << 18))
    df = spark.createDataFrame([("one, two, three",)], "t string").select(F.concat(F.array_repeat(F.lit(0).cast("long"), fingerprints.EXACT), most).alias("f"), one.alias("one"))
    df = df.select("one", fingerprints.combined(F.col("f"), F.col("f")).alias("f"))
    near = fingerprints.likeness(F.col("f"), F.col("one"))
    assert df.select(near.alias("near")).first().near > 0.99


def test_fingerprints_do_not_mind_order_and_can_be_changed(spark):
    df = spark.createDataFrame([("a, b.\nc d\n\ne", "e\n\na, b.\nc d", "c d", "a, b.\ne\n")], "a string, b string, c string, d string")
    print_ = fingerprints.fingerprint
    row = df.select(
        print_(F.col("a")).alias("t"),
        print_(F.col("b")).alias("u"),
        fingerprints.combined(print_(F.col("d")), print_(F.col("c"))).alias("inserted"),
        fingerprints.without(print_(F.col("a")), print_(F.col("c"))).alias("deleted"),
        print_(F.col("d")).alias("w"),
    ).first()
    assert row.t == row.u == row.inserted and row.deleted == row.w != row.t


def test_template_tokens(spark):
    """Fields, lines of fields alone, fields written out, and scripts without spaces, against plain Python."""
    unspaced = re.compile("([฀-໿က-႟ក-៿ぁ-ゖァ-ヺ一-鿿\U00020000-\U0002a6df])")

    def wanted(line):
        apart = unspaced.sub(r" \1 ", line)
        tokens = [t for t in re.split(r"[ \t\n\x0b\f\r]+", apart) if t]
        masked = [templates.VARIABLE if re.search("[0-9]", t) else t for t in tokens]
        return masked if any(t.replace("<*>", "") for t in masked) else tokens

    lines = ["a1 b2", "a 1 b", "12 x", "9", "9 <*>", "<*> <*>", "<*><*> 12", "<<*>*> 7", "<*><*>x 12", "a1 <*> b2", "漢字12", "漢 12", "カタ 1",
             "ไทย 5 abc", "é1 é", "привет 3", "1\x0b2 x", "𠀀1", "x　y 2"]
    made = spark.createDataFrame([(s,) for s in lines], "c string").withColumn("a", templates._apart(F.col("c"))).select("c", templates._tokens(F.col("a")))
    assert dict(map(tuple, made.collect())) == {s: wanted(s) for s in lines}


def test_phrases_of_one_trigger_are_opened_by_their_sides(spark):
    """Two texts with 60 bytes in common hold no common string: their strings are not looked at, as they were before."""
    rng = np.random.default_rng(5)
    alphabet = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)

    def noise(n):
        return bytes(rng.choice(alphabet, n)).decode()

    opened = []
    strings = repeats.strings
    for common, removed in ((60, 0), (99, 0), (100, 100), (101, 101), (130, 130)):
        middle = noise(common)
        texts = [(i, noise(70) + f"{i}" + middle + f"{i}" + noise(70)) for i in range(2)]
        df = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
        found = {r.doc_id: r.n_removed for r in repeats.without_repeats(df, length=100).collect()}
        assert found == {0: 0, 1: removed}
        try:
            repeats.strings = lambda docs, length: opened.append((common, docs.count())) or strings(docs, length)
            repeats.without_repeats(df, length=100).collect()
        finally:
            repeats.strings = strings
    assert dict(opened)[60] == 0 and dict(opened)[100] == 2


@pytest.mark.parametrize("length", [100, 101, 34, 33])
def test_sides_meet_wherever_strings_are_equal(length):
    """Of phrases that share a string, one side is equal; a side out of reach is 0."""
    rng = np.random.default_rng(length)
    one, two = (rng.integers(97, 123, 600).astype(np.uint8) for _ in range(2))
    for size in (length, length + 1, 2 * length):
        for at, to in ((0, 300), (200, 0), (50, 600 - size)):
            other = two.copy()
            other[to : to + size] = one[at : at + size]
            parts = [repeats.parse(t, np.array([0, 600]), length) for t in (one, other)]
            pairs = [(i, j) for i in range(len(parts[0][0])) for j in range(len(parts[1][0])) if parts[0][3][i] == parts[1][3][j]]
            met = 0
            for i, j in pairs:
                mine = {bytes(one[s : s + length]) for s in range(parts[0][1][i], parts[0][2][i] + 1)}
                its = {bytes(other[s : s + length]) for s in range(parts[1][1][j], parts[1][2][j] + 1)}
                if mine & its:
                    met += 1
                    a, b = int(parts[0][5][i]), int(parts[1][5][j])
                    assert (a >> 16 == b >> 16 and a >> 16) or (a & 0xFFFF == b & 0xFFFF and a & 0xFFFF)
            assert met


def test_keys_of_the_same_documents_are_one(spark, monkeypatch):
    """Documents that meet on many keys are compared once in a round, not once a key."""
    seen = []
    across = jaccard.across
    monkeypatch.setattr(jaccard, "across", lambda rows, percent, nearest=False: seen.append(rows.count()) or across(rows, percent, nearest))
    words = [f"w{i}" for i in range(400)]
    near = [" ".join(words[:k] + [f"x{k}", f"y{k}"] + words[k + 2 :]) for k in (50, 150, 250)]
    far = " ".join(words[:330] + [f"z{i}" for i in range(70)])
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*near, far])], "doc_id long, text string")
    made = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(df).collect()}
    assert made[0] == made[1] == made[2] == 0
    assert max(seen) <= 2 ** 4 * 4  # sets of documents, whatever the number of their keys


def test_folded_fingerprints(spark):
    """Few runs or many, a fingerprint comes back as it was; few take half the room."""
    texts = ["", "a", "one two, three. four five six seven\neight", "a. " * 40_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(fingerprints.fingerprint(F.col("t")).alias("v"))
    made = df.withColumn("f", fingerprints.folded(F.col("v"))).select("v", "f", fingerprints.unfolded(F.col("f")).alias("u")).collect()
    assert all(r.v == r.u for r in made)
    assert [r.f["half"] is None for r in made] == [False, False, False, True]


def test_a_slice_is_parsed_in_little_memory(monkeypatch):
    """Running sums and suffix columns of a whole slice took 80 times its bytes in each worker; parts give the same phrases."""
    rng = np.random.default_rng(11)
    flat = rng.integers(97, 123, 2 << 20).astype(np.uint8)
    flat[700_000:701_000] = flat[:1000]
    bounds = np.append(0, np.sort(rng.choice(np.arange(1, len(flat)), 600, replace=False)))
    bounds = np.append(bounds, [len(flat), len(flat)])  # the last text is empty
    starts = np.sort(rng.choice(len(flat) - 100, 200_000, replace=False))
    starts = starts[starts + 100 <= bounds[np.searchsorted(bounds, starts, "right")]]
    tracemalloc.start()
    try:
        made, classes, hashes = repeats.parse(flat, bounds, 100), repeats.suffix_classes(flat, starts, 100), repeats.string_hashes(flat, bounds, starts, 100)
        assert tracemalloc.get_traced_memory()[1] < 30 * len(flat)
    finally:
        tracemalloc.stop()
    strings = [bytes(flat[s : s + 100]) for s in starts.tolist()]
    number = {s: i for i, s in enumerate(sorted(set(strings)))}
    assert classes.tolist() == [number[s] for s in strings]
    monkeypatch.setattr(repeats, "PART", len(flat))
    for some, whole in zip((*made, *hashes), (*repeats.parse(flat, bounds, 100), *repeats.string_hashes(flat, bounds, starts, 100))):
        assert (some == whole).all() and some.dtype == whole.dtype
