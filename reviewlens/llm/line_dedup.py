"""Line dedup by a segment-partition edit join, in DataFrame functions only.

Distinct lines are cut into EDITS + 1 segments. Two lines within EDITS edits
share one segment, unchanged and not far from its place; so each line looks
its own substrings up in the segments of lines of every possible length, only
at the starts that the edits left and right of a match allow. Candidates are
checked by a banded bit-parallel edit distance. Linked lines form classes, of
which the first line stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.common import stage, thinned
from reviewlens.llm.components import components

#: Lines within so many insertions, deletions and changes of characters are linked.
EDITS = 2
#: Shorter lines are linked only if they are identical.
MIN_CHARS = 16
#: Lines of a block, where the lines of a segment are compared with each other.
GROUP = 128
#: Characters of a block; a longer line is a block of its own.
BLOCK_CHARS = 1_000_000
#: Characters whose numbers, odd or even, are compared before any distance.
COUNTED = "abcdefghijklmnopqrstuvwxyz0123456789"


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, version, line_no, line) of every line with a visible character; ``version`` tells texts of one doc_id apart."""
    whole = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    split = whole.select("doc_id", F.xxhash64("t").alias("version"), F.posexplode(F.split("t", "\n", -1)).alias("line_no", "line"))
    return split.where(F.col("line").rlike(r"[^\s]"))


def _identity() -> list[Column]:
    """A line's two 64-bit hashes, with different seeds."""
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")]


def distinct_lines(lines: DataFrame) -> DataFrame:
    """(nr, h1, h2, first, copies, line) of each distinct line; nr numbers the written rows, first is its first place."""
    first = F.min(F.struct("doc_id", "version", "line_no", "line"))
    found = lines.select("doc_id", "version", "line_no", "line", *_identity()).groupBy("h1", "h2").agg(
        first.alias("m"), F.count(F.lit(1)).alias("copies"))
    return stage(found.select(
        F.monotonically_increasing_id().alias("nr"), "h1", "h2", F.struct("m.doc_id", "m.version", "m.line_no").alias("first"), "copies",
        F.col("m.line").alias("line"), F.length("m.line").alias("size")), "lines")


def _segment(size: Column, i: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment i of a line of ``size`` characters; the last ones take the remainder."""
    parts = EDITS + 1
    base = F.floor(size / parts).cast("int")
    longer = size % parts - (parts - 1 - i)
    start = base * i + F.greatest(F.lit(0), longer - 1).cast("int")
    return start, base + (longer > 0).cast("int")


def _key(line: Column, other: Column, i: int, start: Column, length: Column) -> Column:
    """Hash of one substring with the length and segment it stands for. ``line`` is in four bytes per character,
    so that substrings are cut without counting characters from the start."""
    return F.xxhash64(other, F.lit(i), F.substring(line, start * 4 + 1, length * 4))


def index_keys(line: Column, size: Column) -> list[Column]:
    return [_key(line, size, i, *_segment(size, i)) for i in range(EDITS + 1)]


def probe_keys(line: Column, size: Column) -> list[Column]:
    """Keys of the substrings to look up among lines of the same length or up to EDITS shorter.

    With ``gap`` the difference in length, the i-th segment (from 0) of the
    shorter line can match at a shift of at most i edits to its left, and of
    at most EDITS - i edits to its right.
    """
    keys = []
    for gap in range(EDITS + 1):
        other = (size - gap).cast("int")
        for i in range(EDITS + 1):
            start, length = _segment(other, i)
            low, high = max(-i, gap - (EDITS - i)), min(i, gap + (EDITS - i))
            keys += [_key(line, other, i, start + shift, length) for shift in range(low, high + 1)]
    return keys


def enough_pieces(a: Column, b: Column, size_a: Column, limit: int = EDITS, pieces: int = 8) -> Column:
    """Whether all but ``limit`` pieces of a stand in b, ``limit`` characters from their place at the most.

    An edit breaks one piece, so two strings within ``limit`` edits always pass.
    """
    length = F.floor(size_a / pieces).cast("int")
    intact = F.lit(0)
    for i in range(pieces):
        piece = F.substring(a, length * i + 1, length)
        found = F.lit(False)
        for shift in range(-limit, limit + 1):
            found = found | (F.substring(b, F.greatest(length * i + 1 + shift, F.lit(1)), length) == piece)
        intact = intact + found.cast("int")
    return intact >= pieces - limit


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _shared(most: Column, same: Callable[[Column, Column], Column]) -> Column:
    """The largest number of characters, up to ``most``, that are the same; ``same(at, step)`` compares the ``step`` behind the first ``at``."""
    steps = F.transform(F.sequence(F.ceil(F.log2(F.greatest(most, F.lit(1)))).cast("int"), F.lit(0), F.lit(-1)), lambda i: F.pow(F.lit(2), i).cast("int"))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= most) & same(at, step), at + step).otherwise(at))


def edits_at_ends(a: Column, b: Column, size_a: Column, size_b: Column) -> Column:
    """Whether two strings agree but for an edit at either end, once what they begin and end with alike is cut off.

    Where both rests have characters they differ in the first and in the last
    one, so an edit stands at either end and, of two edits, none between.
    """
    least = F.least(size_a, size_b)
    prefix = _shared(least, lambda at, step: F.substring(a, at + 1, step) == F.substring(b, at + 1, step))

    def behind(pre: Column) -> Column:
        suffix = _shared(least - pre, lambda at, step: F.substring(a, size_a - at - step + 1, step) == F.substring(b, size_b - at - step + 1, step))
        return _let(suffix, lambda suf: between(pre, size_a - pre - suf, size_b - pre - suf))

    def between(pre: Column, rest_a: Column, rest_b: Column) -> Column:
        found = F.greatest(rest_a, rest_b) <= EDITS
        for front_a, front_b in ((1, 1), (1, 0), (0, 1)):
            for end_a, end_b in ((1, 1), (1, 0), (0, 1)):
                length, other = rest_a - (front_a + end_a), rest_b - (front_b + end_b)
                found = found | ((length == other) & (length >= 0) & (
                    F.substring(a, pre + front_a + 1, length) == F.substring(b, pre + front_b + 1, length)))
        return found

    return _let(prefix, behind)


def within_edits(a: Column, b: Column, size_a: Column, size_b: Column) -> Column:
    """Whether two strings are within EDITS edits; the distance is computed only where the edits can stand at both ends of what differs."""
    return F.when(edits_at_ends(a, b, size_a, size_b), edit_distance(a, b, size_a, size_b) <= EDITS).otherwise(False)


def edit_distance(a: Column, b: Column, size_a: Column, size_b: Column, limit: int = EDITS) -> Column:
    """Edit distance of two strings if it is at most ``limit``, else a larger number.

    Both have at least ``limit`` characters, and their lengths differ by at
    most ``limit``. One character of b is a step; bit r of a mask is the row
    ``width - 1 - r`` above the band's lower edge, and the words of the last
    column's vertical differences move down with the band.
    """
    width = 2 * limit + 2
    full, top = (1 << width) - 1, 1 << (width - 1)
    word = lambda x: F.lit(x).cast("long")

    def matches(chars_a: Column, char: Column, j: Column) -> Column:
        bits = [F.when(F.get(chars_a, j + (limit - d)) == char, word(1 << (width - 1 - d))).otherwise(word(0)) for d in range(width)]
        mask = bits[0]
        for bit in bits[1:]:
            mask = mask.bitwiseOR(bit)
        return F.struct(mask.alias("m"), j.alias("j"))

    def step(state: Column, at: Column) -> Column:
        plus, minus, m = state["plus"], state["minus"], at["m"]
        sum_ = (m.bitwiseAND(plus) + plus).bitwiseAND(word(full))
        diagonal = sum_.bitwiseXOR(plus).bitwiseOR(m).bitwiseOR(minus)

        def with_diagonal(d: Column) -> Column:
            right_plus = minus.bitwiseOR(d.bitwiseOR(plus).bitwiseXOR(word(full)))
            right_minus = d.bitwiseAND(plus)
            return _let(F.struct(right_plus.alias("p"), right_minus.alias("n"), F.shiftright(d, 1).alias("d")), lambda h: F.struct(
                h["n"].bitwiseOR(h["d"].bitwiseOR(h["p"]).bitwiseXOR(word(full))).alias("plus"),
                h["d"].bitwiseAND(h["p"]).alias("minus"),
                # along the band's lower edge first, then along the last row of a
                F.when(at["j"] < size_a - limit,
                       state["distance"] + F.when(d.bitwiseAND(word(top)) == 0, 1).otherwise(0))
                .otherwise(state["distance"] + F.when(h["p"].bitwiseAND(state["row"]) != 0, 1).otherwise(0)
                           - F.when(h["n"].bitwiseAND(state["row"]) != 0, 1).otherwise(0)).cast("int").alias("distance"),
                F.when(at["j"] < size_a - limit, state["row"]).otherwise(F.shiftright(state["row"], 1)).alias("row")))

        return _let(diagonal, with_diagonal)

    start = F.struct(word(full ^ ((1 << (width - limit - 1)) - 1)).alias("plus"), word(0).alias("minus"),
                     F.lit(limit).cast("int").alias("distance"), word(top >> 1).alias("row"))
    # split() by nothing may leave an empty last part, so the length decides
    # a's characters are a value of their own, or every step would split them anew
    masks = _let(F.split(a, ""), lambda chars: F.transform(
        F.slice(F.split(b, ""), F.lit(1), size_b), lambda char, j: matches(chars, char, j)))
    return F.aggregate(masks, start, step, lambda s: s["distance"])


def parities(line: Column) -> Column:
    """A bit for each character of COUNTED: whether the line holds it an odd number of times.

    An edit turns two bits at the most.
    """
    bytes_ = F.octet_length(line)
    bits = [F.shiftleft((bytes_ - F.octet_length(F.replace(line, F.lit(char), F.lit("")))).bitwiseAND(F.lit(1)).cast("long"), i)
            for i, char in enumerate(COUNTED)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def _near(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """Whether two lines, given by their fields, are within EDITS edits; what costs least is asked first."""
    alike = (F.abs(a("size") - b("size")) <= EDITS) & (F.bit_count(a("mask").bitwiseXOR(b("mask"))) <= 2 * EDITS)
    return F.when(alike, within_edits(a("line"), b("line"), a("size"), b("size"))).otherwise(False)


def buckets(lines: DataFrame) -> DataFrame:
    """(key, nr, n, hub): the lines of each segment that two lines or more meet in, their number, and the first of them.

    A line comes with the keys of its own segments and with those it looks up;
    lines that only look the same segment up need not meet. The rows move once.
    """
    wide = lines.where(F.col("size") >= MIN_CHARS).select("nr", "size", F.encode("line", "UTF-32").alias("wide"))
    own = F.array(*index_keys(F.col("wide"), F.col("size")))
    looked_up = F.array(*probe_keys(F.col("wide"), F.col("size")))
    keyed = wide.select("nr", own.alias("own"), looked_up.alias("looked_up")).select(
        "nr", F.posexplode(F.concat("own", F.array_except("looked_up", "own"))).alias("place", "key"))
    # number and kind in one column, as almost all keys leave right behind the shuffle
    tagged = keyed.select("key", (F.col("nr") * 2 + (F.col("place") > EDITS).cast("long")).alias("tag"))
    met = Window.partitionBy("key")
    counted = tagged.withColumns({
        "n": F.count(F.lit(1)).over(met), "hub": F.floor(F.min("tag").over(met) / 2), "kind": F.min(F.col("tag") % 2).over(met)})
    return counted.where("n > 1 AND kind = 0").select("key", F.expr("tag div 2").alias("nr"), "n", "hub")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) of line numbers whose lines are within EDITS edits."""
    side = lambda n: texts.select(*(F.col(c).alias(n if c == "nr" else f"{c}_{n}") for c in texts.columns))
    # pairs and texts grow with the lines and are never broadcast, so the plan is the same for any number of them
    both = pairs.hint("merge").join(side("v"), "v").hint("merge").join(side("u"), "u")
    return both.where(_near(lambda c: F.col(f"{c}_u"), lambda c: F.col(f"{c}_v"))).select("u", "v")


def _spanning(found: Column) -> Column:
    """Of rows (nr, others) of linked line numbers, links (label, nr) enough to hold them together: one less than there are lines."""
    nodes = F.array_union(F.transform(found, lambda p: p["nr"]), F.flatten(F.transform(found, lambda p: p["others"])))
    start = F.transform(nodes, lambda nr: F.struct(nr.alias("nr"), nr.alias("label")))

    def merge(state: Column, p: Column) -> Column:
        touched = F.filter(state, lambda e: (e["nr"] == p["nr"]) | F.array_contains(p["others"], e["nr"]))
        return _let(F.transform(touched, lambda e: e["label"]), lambda labels: F.transform(state, lambda e: F.struct(
            e["nr"].alias("nr"), F.when(F.array_contains(labels, e["label"]), F.array_min(labels)).otherwise(e["label"]).alias("label"))))

    return F.aggregate(found, start, merge, lambda state: F.filter(state, lambda e: e["nr"] != e["label"]))


def open_links(shared: DataFrame, texts: DataFrame, found: DataFrame, group: int = GROUP) -> DataFrame:
    """Links in the segments whose lines still lie in two classes or more.

    The lines of such a segment are cut into blocks of bounded size, and every
    two blocks meet in a row of their own, wherever the segment's other rows
    are. A row gives links enough to join its lines, never its pairs, so lines
    that are a little too different cost comparisons but no rows.
    """
    owned = shared.select("key", "nr").join(found, "nr", "left").withColumn("component", F.coalesce("component", "nr"))
    is_open = owned.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a != b")
    rest = owned.join(is_open.select("key"), "key", "left_semi").join(texts, "nr")
    before = Window.partitionBy("key").orderBy("nr").rowsBetween(Window.unboundedPreceding, -1)
    chunk = F.count("nr").over(before) / group + F.coalesce(F.sum("size").over(before), F.lit(0)) / BLOCK_CHARS
    placed = rest.withColumn("chunk", F.floor(chunk).cast("int"))
    placed = placed.withColumn("last", F.max("chunk").over(Window.partitionBy("key")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
    fields = ["nr", "component", "size", "mask", "line", "chunk"]
    met = placed.groupBy("key", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")).agg(
        F.collect_list(F.struct(*fields)).alias("members"))
    of = lambda side: F.filter("members", lambda m: m["chunk"] == F.col(side))
    met = met.select(of("low").alias("first"), of("high").alias("second"), (F.col("low") == F.col("high")).alias("same"))

    def partners(x: Column) -> Column:
        fits = lambda y: (x["component"] != y["component"]) & (~F.col("same") | (y["nr"] < x["nr"])) & _near(x.getField, y.getField)
        return F.struct(x["nr"].alias("nr"), F.transform(F.filter("first", fits), lambda y: y["nr"]).alias("others"))

    linked = F.filter(F.transform("second", partners), lambda p: F.size(p["others"]) > 0)
    return met.select(F.explode(_let(linked, _spanning)).alias("link")).select(
        F.col("link.label").alias("u"), F.col("link.nr").alias("v")).distinct()


def line_classes(lines: DataFrame, group: int = GROUP) -> DataFrame:
    """(nr, component) of the distinct lines that links join, component being the smallest nr of a class.

    Lines are first compared with one line of each segment they share, which
    settles segments of two lines and joins almost all of a large class.
    """
    shared = stage(buckets(lines), "buckets")
    ids = shared.select("nr").distinct()
    mine = thinned(lines.select("nr", "line", "size"), "nr", ids).join(ids.hint("merge"), "nr", "left_semi")
    texts = stage(mine.withColumn("mask", parities(F.col("line"))), "texts")
    to_hub = shared.where("nr != hub").select(F.col("hub").alias("u"), F.col("nr").alias("v")).distinct()
    found = components(stage(verified(to_hub, texts), "links")).withColumnRenamed("node", "nr")
    more = stage(open_links(shared.where("n > 2"), texts, found, group), "links")
    if more.isEmpty():
        return found
    return components(found.select(F.col("nr").alias("u"), F.col("component").alias("v")).unionByName(more)).withColumnRenamed("node", "nr")


def removed_lines(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """(doc_id, version, line_no, keep_doc_id, keep_line_no): lines that go, and the first line of their class, which stays."""
    all_lines = _lines(docs)
    lines = distinct_lines(all_lines)
    found = line_classes(lines, group)
    classed = lines.drop("line", "size").join(found, "nr", "left")
    # lines that stand once and have no link are in no one's way
    classed = classed.where("copies > 1 OR component IS NOT NULL").withColumn("component", F.coalesce("component", "nr"))
    firsts = classed.groupBy("component").agg(F.min("first").alias("keep"))
    kept = stage(classed.join(firsts, "component").select("h1", "h2", "keep"), "kept")
    placed = all_lines.select("doc_id", "version", "line_no", *_identity()).join(kept, ["h1", "h2"])
    return placed.where(F.struct("doc_id", "version", "line_no") > F.col("keep")).select(
        "doc_id", "version", "line_no", F.col("keep.doc_id").alias("keep_doc_id"), F.col("keep.line_no").alias("keep_line_no"))


def line_dedup(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_lines, n_removed and ``kept``, the text without the removed lines, for each row.

    Lines end at a line feed. Lines of MIN_CHARS characters and more are linked
    if they are within EDITS edits, shorter ones if they are identical; links
    join lines into classes, and the first line of a class, by doc_id and line
    number, stays. Lines of white space alone always stay. A null text is one
    empty line. Rows that repeat in full are one document; of rows that share
    a doc_id and differ in text, each is a document of its own, ordered by a
    hash of the text. Rows without doc_id lose nothing. Other columns are not read.
    """
    gone = stage(removed_lines(docs, group).groupBy("doc_id", "version").agg(F.collect_set("line_no").alias("gone")), "gone")
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    whole = whole.withColumn("version", F.xxhash64("text")).join(gone, ["doc_id", "version"], "left")
    rows = whole.withColumn("lines", F.split("text", "\n", -1))
    rows = rows.withColumn("stay", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>"))))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n"))
    return rows.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                       (F.size("lines") - F.size("stay")).cast("long").alias("n_removed"), kept.alias("kept"))
