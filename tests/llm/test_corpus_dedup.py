"""Exact, near, line, suffix and substring dedup against plain Python."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.llm import anchors, exact_dedup, line_dedup, minhash, substring_dedup, suffix_dedup
from reviewlens.llm.components import components

#: Edge rows every operator meets: null and empty texts, white space, repeats, a clashing column, a null id.
EDGES = [(900, None), (901, ""), (902, " \t\n "), (903, "one"), (904, "one"), (905, "One two three"), (None, "lost text " * 30)]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # names the operators use inside
    return df.withColumns({name: F.lit("x") for name in ("name", "level", "key", "slot", "spans", "nr", "line", "lang")})


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def corpus():
    """Documents of random words with copies, edited copies and shared passages, and the edge rows."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    docs = []
    for i in range(90):
        kind = i % 6
        text = [rng.choice(words) for _ in range(rng.randint(1, 160))]
        if kind == 1:
            text = docs[i - 1][1].split(" ")
        elif kind == 2:
            text = docs[i - 2][1].split(" ")
            for _ in range(rng.randint(1, 4)):
                text[rng.randrange(len(text))] = rng.choice(words)
        elif kind == 3:
            at = rng.randint(0, len(text))
            text[at:at] = passage[: rng.randint(25, 60)]
        docs.append((i, rng.choice([" ", " ", "\n"]).join(text) if kind != 1 else docs[i - 1][1]))
    return docs + EDGES


def plain_texts(corpus):
    return sorted((i, (t or "").encode()) for i, t in corpus if i is not None)


@pytest.mark.parametrize("block", [7, 2048])
def test_exact_dedup(spark, corpus, block):
    normal = {i: exact_normal(t) for i, t in corpus}
    found = by_id(exact_dedup.exact_dedup(frame(spark, corpus), block))
    assert set(found) == set(normal)
    for i, text in normal.items():
        same = [j for j, t in normal.items() if t == text]
        keep = min((j for j in same if j is not None), default=None)
        r = found[i]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, len(same), i == keep)
        assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def exact_normal(text):
    import re
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup_names_hot_blocks_apart(spark):
    rows = [(i, "a" * 40 if i % 3 else f"{i} b" * 9) for i in range(4000)]
    found = by_id(exact_dedup.exact_dedup(frame(spark, rows), 16))
    assert sum(r["kept"] for r in found.values()) == 1 + sum(1 for i in range(4000) if i % 3 == 0)
    assert found[2]["keep_id"] == 1 and found[2]["group_size"] == sum(1 for i in range(4000) if i % 3)


def test_repeated_rows_give_one_row(spark):
    found = exact_dedup.exact_dedup(frame(spark, [(1, "a b"), (1, "a b"), (2, "a  b")])).collect()
    assert sorted((r["doc_id"], r["group_size"], r["kept"]) for r in found) == [(1, 3, True), (2, 3, False)]
    kept = exact_dedup.drop_copies(frame(spark, [(1, "a b"), (2, "a  b"), (None, "c")]))
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == ["1", "None"] and "lang" in kept.columns


def shingles(text):
    words = text.lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts}
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_near_duplicates(spark, corpus):
    expected = brute_components(plain_texts(corpus))
    found = by_id(minhash.near_duplicates(frame(spark, corpus)))
    lost = found.pop(None)
    assert lost["component_id"] is None and lost["kept"]
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == expected
    assert all(r["kept"] == (i == r["component_id"]) for i, r in found.items())


@pytest.mark.parametrize("few", [1, 4, 1000])
def test_pairs_of_small_buckets_are_compared_as_rows(spark, monkeypatch, few):
    # whichever buckets count as small, the components are the same
    monkeypatch.setattr(minhash, "FEW", few)
    rng = random.Random(10)
    text, docs = [f"w{rng.randrange(10**6)}" for _ in range(90)], []
    for i in range(16):
        docs.append((i * 5 % 16, " ".join(text)))
        text[rng.randrange(90)] = f"w{rng.randrange(10**6)}"
    found = by_id(minhash.near_duplicates(frame(spark, docs)))
    expected = brute_components([(i, t.encode()) for i, t in docs])
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == expected


@pytest.mark.parametrize("block", [3, 1024])
def test_a_group_that_hangs_together_by_chains(spark, monkeypatch, block):
    # neighbours are similar enough, far ends are not; no hub sees them all
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(9)
    text, docs = [f"w{rng.randrange(10**6)}" for _ in range(120)], []
    for i in range(40):
        docs.append((i * 7 % 40, " ".join(text)))
        if i % 13 == 12:
            for _ in range(40):
                text[rng.randrange(120)] = f"w{rng.randrange(10**6)}"
        else:
            text[rng.randrange(120)] = f"w{rng.randrange(10**6)}"
    expected = brute_components([(i, t.encode()) for i, t in docs])
    found = by_id(minhash.near_duplicates(frame(spark, docs)))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == expected


def test_rows_of_a_large_group_grow_with_its_members(spark):
    # (key, component sizes): one large component and strays, three components, all different, one that fits
    groups = {1: [400, 1, 1, 1, 1, 1], 2: [30, 25, 8], 3: [1] * 23, 4: [9, 1]}
    rows = [(key, sum(sizes), 0, place) for key, sizes in groups.items() for place, n in enumerate(sizes) for _ in range(n)]
    rest = spark.createDataFrame(
        [(*row[:3], i, row[3]) for i, row in enumerate(rows)], "key long, n long, band int, doc_id long, component long")
    placed = minhash.chunk_rows(rest, 10).collect()
    met, components_of = collections.Counter(), {r["doc_id"]: (r["key"], r["component"]) for r in rest.collect()}
    tasks = collections.defaultdict(list)
    for r in placed:
        tasks[r["key"], r["low"], r["high"]].append((r["chunk"], r["doc_id"]))
        assert r["chunk"] in (r["low"], r["high"])
    for (_, low, high), members in tasks.items():
        met.update(tuple(sorted((i, j))) for c, i in members for d, j in members
                   if (low == high and i < j or c == low and d == high != low) and components_of[i][1] != components_of[j][1])
    pairs = [(i, j) for i in components_of for j in components_of
             if i < j and components_of[i][0] == components_of[j][0] and components_of[i][1] != components_of[j][1]]
    assert met == collections.Counter(pairs)
    # cut into 41 blocks that all meet each other these would be 16,605
    assert sum(r["key"] == 1 for r in placed) <= 2 * 405
    assert sum(r["key"] == 4 for r in placed) == 10


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 2**63, 4000).astype(np.uint64))
    b = np.concatenate([a[:3000], rng.integers(0, 2**63, 1000).astype(np.uint64)])
    x, y = minhash.signatures([a, np.unique(b)])
    assert abs((x == y).mean() - 0.6) < 0.15


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)]
    parent = {n: n for e in links for n in e}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        parent[high] = low
    found = components(spark.createDataFrame(links, "u long, v long"))
    rows = {r["node"]: r["component"] for r in found.collect()}
    assert found.count() == len(rows)
    assert rows == {n: top(n) for n in parent if any(n in e and e[0] != e[1] for e in links)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_repeats(items, length):
    """{doc: mask of removed elements}: windows that start earlier, in (doc, place) order."""
    seen, masks = set(), {}
    for i, x in items:
        change = [0] * (len(x) + 1)
        for p in range(len(x) - length + 1):
            window = tuple(x[p : p + length])
            if window in seen:
                change[p] += 1
                change[p + length] -= 1
            seen.add(window)
        masks[i] = np.cumsum(change[:-1]) > 0 if len(x) else np.zeros(0, dtype=bool)
    return masks


def test_substring_dedup(spark, corpus):
    items = [(i, t.split()) for i, t in plain_texts(corpus)]
    masks = brute_repeats(items, 20)
    found = by_id(substring_dedup.digests(substring_dedup.substring_dedup(frame(spark, corpus))))
    assert found.pop(None)["n_removed"] == 0
    assert set(found) == set(masks) and any(m.any() for m in masks.values())
    for i, words in items:
        kept = b" ".join(w for w, gone in zip(words, masks[i]) if not gone)
        r = found[i]
        assert (r["n_words"], r["n_removed"]) == (len(words), int(masks[i].sum()))
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_one_document_that_repeats_itself(spark):
    text = " ".join(f"w{i % 23}" for i in range(200)) + " " + "x " * 90
    r = substring_dedup.substring_dedup(frame(spark, [(1, text)])).first()
    mask = brute_repeats([(1, text.split())], 20)[1]
    assert r["n_removed"] == mask.sum() and r["n_words"] == 290


@pytest.mark.parametrize("lot", [1_000_000, 20])
def test_suffix_dedup(spark, corpus, lot):
    items = plain_texts(corpus)
    masks = brute_repeats(items, 100)
    found = by_id(suffix_dedup.digests(suffix_dedup.suffix_dedup(frame(spark, corpus), lot)))
    assert found.pop(None)["n_removed"] == 0
    for i, text in items:
        kept = bytes(b for b, gone in zip(text, masks[i]) if not gone)
        runs = sum(1 for p, gone in enumerate(masks[i]) if gone and (p == 0 or not masks[i][p - 1]))
        r = found[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(text), int(masks[i].sum()), runs)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("bits", [3, 26])
def test_leftmost_minima_of_any_number_of_values(monkeypatch, bits):
    # with few bits for places the array is as long as texts of over 64 MiB are otherwise
    monkeypatch.setattr(anchors, "_PLACE_BITS", bits)
    values = np.random.default_rng(1).integers(0, 2**63, 3000).astype(np.uint64)
    values[1000:1400] = values[1000]
    found = anchors.leftmost_minima(values, 40)
    assert found.tolist() == [i + int(values[i : i + 40].argmin()) for i in range(len(values) - 39)]


@pytest.mark.parametrize("length", [8, 24, 27, 50, 100, 101])
@pytest.mark.parametrize("letters", [2, 250])
def test_sorted_suffixes(length, letters):
    codes = np.random.default_rng(length).integers(1, letters + 1, 700).astype(np.uint8)
    codes = np.concatenate([codes, codes[200:]])
    order, raw = suffix_dedup.sorted_suffixes(codes, length), codes.tobytes()
    prefixes = [raw[i : i + length].ljust(length, b"\0") for i in order.tolist()]
    assert sorted(order.tolist()) == list(range(len(codes))) and prefixes == sorted(prefixes)
    same = suffix_dedup.equal_neighbours(codes, order, length)
    assert same[1:].tolist() == [a == b for a, b in zip(prefixes, prefixes[1:])]


@pytest.mark.parametrize("dedup", [substring_dedup.substring_dedup, suffix_dedup.suffix_dedup, line_dedup.line_dedup,
                                   minhash.near_duplicates, exact_dedup.exact_dedup])
def test_empty_tables_and_repeated_rows(spark, dedup):
    assert dedup(frame(spark, [])).count() == 0
    rows = [(1, "a sentence of some length that is here twice " * 6)] * 2
    for r in dedup(frame(spark, rows)).collect():
        found = r.asDict()
        # a repeated row is not a copy of itself; what repeats inside the text goes in both
        assert found["doc_id"] == 1 and found.get("kept", True) is not False


def thue_morse(zero, one, n=10):
    """Sequences of this shape have equal polynomials modulo 2^64, whatever the base."""
    out = [zero]
    other = {zero: one, one: zero}
    for _ in range(n):
        out += [other[x] for x in out]
    return out


def test_words_made_to_share_a_polynomial(spark):
    one, two = "".join(thue_morse("a", "b")), "".join(thue_morse("b", "a"))
    rest = [f"word{i}" for i in range(19)]
    rows = [(1, " ".join([one, *rest])), (2, " ".join([two, *rest])), (3, " ".join(thue_morse("xx", "yy"))), (4, " ".join(thue_morse("yy", "xx")) + " end")]
    words = dict(rows)
    masks = brute_repeats([(i, t.split()) for i, t in rows], 20)
    found = by_id(substring_dedup.substring_dedup(frame(spark, rows)))
    assert {i: r["n_removed"] for i, r in found.items()} == {i: int(masks[i].sum()) for i in words}
    assert found[1]["n_removed"] == found[2]["n_removed"] == 0
    short = [(1, " ".join([one, *rest[:4]])), (2, " ".join([two, *rest[:4]])), (3, one), (4, two)]
    found = by_id(minhash.near_duplicates(frame(spark, short)))
    assert {i: r["component_id"] for i, r in found.items()} == {1: 1, 2: 2, 3: 3, 4: 4}


@pytest.mark.parametrize("dedup", [substring_dedup.substring_dedup, suffix_dedup.suffix_dedup, line_dedup.line_dedup])
def test_one_id_with_several_texts(spark, dedup):
    text = lambda name, n: "\n".join(" ".join(f"{name}{i}x{j}" for j in range(24)) for i in range(n))
    alone = [(1, text("a", 9)), (1, text("b", 2)), (1, text("c", 9)), (2, text("d", 3))]
    kept = lambda r: bytes(r["kept"]) if isinstance(r["kept"], (bytes, bytearray)) else r["kept"].encode()
    found = dedup(frame(spark, alone)).collect()
    assert sorted((r["doc_id"], b"".join(kept(r).split())) for r in found) == sorted((i, b"".join(t.encode().split())) for i, t in alone)
    # a copy in one of them is gone from one place only, and rows that repeat in full fare alike
    rows = [(1, text("a", 5)), (1, text("a", 5)), (1, text("b", 2) + "\n" + text("a", 5)), (3, text("b", 2))]
    found = dedup(frame(spark, rows)).collect()
    assert len(found) == 4 and sum(r["n_removed"] == 0 for r in found) in (1, 2)
    left = [kept(r) for r in found if r["doc_id"] == 1]
    assert all(any(f"{name}1x5".encode() in t for t in left) for name in "ab")
    assert sum(b"b1x5" in kept(r) for r in found) == 1


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        above, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(min(above[j] + (x != y), above[j + 1] + 1, row[j] + 1))
    return row[-1]


def test_banded_edit_distance(spark):
    rng, rows = random.Random(5), []
    while len(rows) < 1200:
        a = [rng.choice(rng.choice(["ab", "abcdé日"])) for _ in range(rng.randint(3, 30))]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(b))
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é"])
        if len(b) > 2 and abs(len(a) - len(b)) <= 2:
            rows.append(("".join(a), "".join(b), edit_distance(a, b)))
    df = spark.createDataFrame(rows, "a string, b string, d int")
    sides = (F.col("a"), F.col("b"), F.length("a"), F.length("b"))
    got = df.withColumn("e", line_dedup.edit_distance(*sides)).withColumn("pass", line_dedup.enough_pieces(*sides[:3]))
    assert all(r["pass"] for r in got.filter("d <= 2 AND length(a) >= 8").collect())
    assert [r for r in got.collect() if min(r["d"], r["e"]) <= 2 and r["d"] != r["e"]] == []


@pytest.mark.parametrize("group", [64, 1])
def test_line_dedup(spark, group):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefg h") for _ in range(rng.randint(5, 50))).strip() or "z" for _ in range(40)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                at = rng.randrange(len(line) + 1)
                line[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "y"])
            lines.append("".join(line))
        docs.append((i, "\n".join(lines + [""] * (i % 3))))
    docs += [(70, None), (71, "  \n \n")]
    lines = [(i, n, x) for i, t in docs for n, x in enumerate((t or "").split("\n")) if x.strip()]
    known = sorted({x for _, _, x in lines})
    parent = {x: x for x in known}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in known:
        for b in known:
            if a < b and min(len(a), len(b)) >= 16 and abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= 2:
                parent[top(a)] = top(b)
    first = {}
    for i, n, x in sorted(lines):
        first.setdefault(top(x), (i, n))
    got = by_id(line_dedup.line_dedup(frame(spark, docs), group))
    for i, text in docs:
        parts = (text or "").split("\n")
        kept = [x for n, x in enumerate(parts) if not x.strip() or first[top(x)] == (i, n)]
        assert (got[i]["n_lines"], got[i]["n_removed"], got[i]["kept"]) == (len(parts), len(parts) - len(kept), "\n".join(kept))
    assert collections.Counter(r["n_removed"] > 0 for r in got.values())[True] > 5


def test_edits_at_both_ends_of_what_differs(spark):
    rng, rows = random.Random(6), []
    while len(rows) < 1500:
        a = [rng.choice(rng.choice(["ab", "abcdé日😀"])) for _ in range(rng.randint(3, 40))]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(b))
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é", "😀"])
        if len(b) > 2 and abs(len(a) - len(b)) <= 2:
            rows.append(("".join(a), "".join(b), edit_distance(a, b)))
    df = spark.createDataFrame(rows, "a string, b string, d int")
    sides = (F.col("a"), F.col("b"), F.length("a"), F.length("b"))
    got = df.select("a", "b", "d", line_dedup.edits_at_ends(*sides).alias("ends"), line_dedup.within_edits(*sides).alias("near"),
                    F.bit_count(line_dedup.parities(sides[0]).bitwiseXOR(line_dedup.parities(sides[1]))).alias("bits")).collect()
    assert [r for r in got if (r["d"] <= 2) != r["ends"] or (r["d"] <= 2) != r["near"]] == []
    assert [r for r in got if r["bits"] > 2 * r["d"]] == []


def test_lines_that_share_a_segment_are_never_paired(spark):
    # half of each line is the same; every fourth line has a near copy, of which no hub of the segment knows
    rng = random.Random(9)
    lines = ["the same beginning of all lines, " + "".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(240)]
    near = [line[:-1] + "x" for line in lines[::4]]
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines + near)], "doc_id long, text string")
    found = line_dedup.distinct_lines(line_dedup._lines(docs))
    shared = line_dedup.buckets(found).cache()
    assert shared.agg(F.max("n")).first()[0] >= 300
    assert shared.where("n > 2 AND nr != hub").count() <= 12 * 300
    links = line_dedup.open_links(shared, found.withColumn("mask", line_dedup.parities(F.col("line"))),
                                  spark.createDataFrame([], "nr long, component long"), group=50)
    assert links.count() == len(near)
    gone = by_id(line_dedup.line_dedup(docs, 50))
    assert sorted(i for i, r in gone.items() if r["n_removed"]) == list(range(240, 300))
