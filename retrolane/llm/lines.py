"""Near-duplicate lines by a segment-partition edit join, in DataFrame operations only.

Lines within EDITS edits of each other share, unchanged, one of EDITS + 1 segments that the shorter
line is cut into: EDITS edits can't touch all of them. Segments are indexed by number, line length
and hash; a line probes the index of every length that it may meet, at the few places where a
segment can stand if the edits before and after it are to stay within the limit. Pairs that meet
are decided by an edit distance that keeps one band of the table, as wide as the limit allows, in
the bits of two integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retrolane.llm.common import stage

EDITS = 2
MIN_CHARS = 20
EQUAL_CHARS = 1  # the registered query's bound for equal lines
MOST_MET = 16  # lines of one key that every line probing it meets; larger groups are looked at more closely first
GRAMS = (1, 2)  # characters at once for that look
MOST_TOLD = 1_000_000  # ids that may be broadcast, after counting them


Place = tuple[int, int, int]


def _keyed(lines: DataFrame, edits: int, places: list[Place], *columns: Column) -> DataFrame:
    """The columns and, as key, hashes of the pieces of a line (line, length) that stand at the places (i, gap, shift).

    These are segment i, moved by shift, of lines shorter by gap. Segments are of about equal length; the
    later ones take the rest. The places are rows, not code: one small expression over them compiles, a
    dozen written out would not, and an array of keys would not be compiled at all.
    """
    names = ("i", "gap", "shift")
    rows = [F.struct(*(F.lit(value).alias(name) for name, value in zip(names, place, strict=True))) for place in places]
    lines = lines.withColumn("place", F.explode(F.array(*rows)))
    i, parts = F.col("place.i"), edits + 1
    whole = F.col("length") - F.col("place.gap")
    base = F.call_function("div", whole, F.lit(parts)).cast("int")
    extra = F.greatest(F.lit(0), i - (parts - whole % parts))
    more = F.when(i >= parts - whole % parts, 1).otherwise(0)
    piece = F.col("line").substr(base * i + extra + 1 + F.col("place.shift"), base + more)
    own = ((F.col("place.gap") == 0) & (F.col("place.shift") == 0)).alias("own")
    return lines.select(*columns, F.xxhash64(i, whole, piece).alias("key"), own)


def _places(edits: int) -> list[Place]:
    """Places where a segment of a shorter or equally long line may stand.

    With i segments before, the shift is at most i; with edits - i behind, it is as close to the gap.
    The places (i, 0, 0) are the line's own segments, its entries in the index.
    """
    places = []
    for gap in range(edits + 1):
        for i in range(edits + 1):
            for shift in range(max(-i, gap - (edits - i)), min(i, gap + (edits - i)) + 1):
                places.append((i, gap, shift))
    return places


# Letters whose counts, one byte each, travel with the keys.
PACKED = "etanis"


def packed_counts(line: Column, length: Column) -> Column:
    """The length and the counts of the packed letters, modulo 256, as the bytes of a long.

    Each letter leaves the line once it is counted, so that the next one is looked for in less text.
    """
    out = (length % 256).cast("long")
    for i, letter in enumerate(PACKED, 1):
        less = F.replace(line, F.lit(letter))
        out = out + F.shiftleft(((F.octet_length(line) - F.octet_length(less)) % 256).cast("long"), 8 * i)
        line = less
    return out


def packed_near(one: Column, two: Column, edits: int) -> Column:
    """Whether packed counts leave room for the edits: each moves two of them by one at most."""
    apart = F.lit(0)
    for i in range(1, len(PACKED) + 1):
        gap = F.pmod(F.shiftright(one, 8 * i).bitwiseAND(F.lit(255)) - F.shiftright(two, 8 * i).bitwiseAND(F.lit(255)), F.lit(256))
        apart = apart + F.least(gap, F.lit(256) - gap)
    return apart <= 2 * edits


def packed_equal_length(one: Column, two: Column) -> Column:
    """Whether lines that meet, whose lengths differ by a few characters at most, are equally long."""
    return one.bitwiseXOR(two).bitwiseAND(F.lit(255)) == 0


def gram_bits(line: Column, q: int) -> Column:
    """A long with a bit flipped for every q neighbouring characters, chosen by their hash."""
    one = F.lit(1).cast("long")
    starts = F.filter(F.sequence(F.lit(0), F.length(line)), lambda i: i <= F.length(line) - q)

    def bits(known: Column) -> Column:
        gram = lambda i: F.hash(*(F.get(known, i + k) for k in range(q)))
        return F.aggregate(starts, F.lit(0).cast("long"), lambda out, i: out.bitwiseXOR(F.call_function("shiftleft", one, gram(i))))

    # the array of characters is bound once, else it would be made anew for every step
    return F.transform(F.array(F.split(line, "")), bits)[0]


def grams_near(one: Column, two: Column, q: int, edits: int) -> Column:
    """Whether the bits leave room for the edits: each takes q grams away and adds q at most."""
    return F.bit_count(one.bitwiseXOR(two)) <= 2 * q * edits


def edit_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of two strings if it is at most edits, else a number above edits.

    One column of the table at a time, only the band of 2 * edits + 1 rows around the diagonal, as the
    bits of two integers that say where the value rises (up) or falls (down) from one row to the next;
    bit 0 is the highest row. The value at the lowest row of the band moves along its diagonal.
    """
    width = 2 * edits + 1
    mask = (1 << width) - 1
    rows = F.slice(F.split(a, ""), 1, F.length(a))
    blank = F.array_repeat(F.lit(""), edits)  # rows outside the table match nothing
    rows = F.concat(blank, rows, F.array_repeat(F.lit(""), F.greatest(F.lit(0), F.length(b) - F.length(a)) + edits + 1))
    columns = F.arrays_zip(
        F.slice(F.split(b, ""), 1, F.length(b)).alias("c"), F.sequence(F.lit(1), F.length(b)).alias("j")
    )

    def equal(known: Column, x: Column) -> Column:
        bits = F.lit(0)
        for k in range(width):
            bits = bits + F.when(F.get(known, x["j"] - 1 + k) == x["c"], 1 << k).otherwise(0)
        return bits

    def step(state: Column, match: Column) -> Column:
        def then(d: Column) -> Column:
            rise = state["down"].bitwiseOR((d.bitwiseOR(state["up"])).bitwiseXOR(F.lit(mask)))
            fall = d.bitwiseAND(state["up"])
            diagonal = F.shiftright(d, 1)
            return F.struct(
                fall.bitwiseOR(diagonal.bitwiseOR(rise).bitwiseAND(F.lit(mask)).bitwiseXOR(F.lit(mask))).alias("up"),
                diagonal.bitwiseAND(rise).alias("down"),
                (state["low"] + F.when(d.bitwiseAND(F.lit(1 << (width - 1))) != 0, 0).otherwise(1)).alias("low"),
            )

        carried = (match.bitwiseAND(state["up"]) + state["up"]).bitwiseXOR(state["up"])
        d = carried.bitwiseOR(match).bitwiseOR(state["down"]).bitwiseAND(F.lit(mask))
        return F.transform(F.array(d), then)[0]

    start = F.struct(
        F.lit(mask & ~((1 << edits) - 1)).alias("up"), F.lit(0).alias("down"), F.lit(edits).alias("low")
    )
    # the array of rows is bound once, else it would be made anew for every column
    matches = F.transform(F.array(rows), lambda known: F.transform(columns, lambda x: equal(known, x)))[0]
    end = F.aggregate(matches, start, step)
    # after a step bit 0 stands for the highest row of the next column's band; the wanted value lies
    # above the lowest row of this one, with the rises and falls from this bit on in between
    at = F.length(a) - F.length(b) + edits

    def climb(state: Column) -> Column:
        over = F.lit(mask >> 1) - (F.call_function("shiftleft", F.lit(1), at) - 1)
        rises = F.bit_count(state["up"].bitwiseAND(over))
        falls = F.bit_count(state["down"].bitwiseAND(over))
        return state["low"] - rises + falls

    near = F.abs(F.length(a) - F.length(b)) <= edits
    value = F.when(F.length(b) == 0, F.length(a)).otherwise(F.transform(F.array(end), climb)[0])
    return F.when(near, value).otherwise(edits + 1)


# Letters whose counts are compared before two lines are.
COUNTED = "etanoirsuhdlcm"


def histogram(line: Column) -> Column:
    """How often a line holds each counted letter, and its length."""
    length = F.length(line)
    octets = F.octet_length(line)  # the letters take one byte each
    return F.array(length, *(octets - F.octet_length(F.replace(line, F.lit(letter))) for letter in COUNTED))


def may_be_near(one: Column, two: Column, edits: int) -> Column:
    """Whether histograms leave room for the edits: each changes the counts of two letters by one at most."""
    apart = F.lit(0)
    for i in range(1, len(COUNTED) + 1):
        apart = apart + F.abs(one[i] - two[i])
    return (F.abs(one[0] - two[0]) <= edits) & (apart <= 2 * edits)


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """Lines of at least min_chars characters with their place and two hashes."""
    lines = docs.select("doc_id", "tag", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.where(F.length("line") >= min_chars)
    return lines.withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line")})


def _told(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= MOST_TOLD else ids


def _without_repeats(lines: DataFrame, classes: DataFrame) -> DataFrame:
    """The lines, each only where it stands first; if too many repeat to be told of, rare ones stay with their repeats.

    Repeats change no pair, but each would meet all that the first one meets.
    """
    least = 2
    while (often := classes.where(F.col("n") >= least)).count() > MOST_TOLD:
        least *= 2
    often = often.select("h1", "h2", F.struct("doc_id", "tag", "pos").alias("first"))
    lines = lines.join(F.broadcast(often), ["h1", "h2"], "left")
    return lines.where(F.col("first").isNull() | (F.struct("doc_id", "tag", "pos") == F.col("first")))


def _texts(docs: DataFrame, classes: DataFrame, named: DataFrame, min_chars: int) -> DataFrame:
    """The lines of the named hashes (h1), each once, as they stand at their first place."""
    wanted = stage(classes.join(named, "h1", "left_semi"), "wanted")
    holders = wanted.select("doc_id").distinct()
    texts = _lines(docs.join(_told(holders), "doc_id", "left_semi"), min_chars)
    places = wanted.select("doc_id", "tag", "pos", "h1", "h2")
    return stage(texts.join(_told(places), ["doc_id", "tag", "pos", "h1", "h2"]).dropDuplicates(["h1", "h2"]), "wanted")


def _may_meet(edits: int) -> Column:
    """Whether two lines that share a key (h1, letters and g1, others) have to be looked at, here rather than the other way round."""
    # equally long lines are in each other's index: one of the two meetings is enough
    once = ~packed_equal_length(F.col("letters"), F.col("others")) | (F.col("h1") < F.col("g1"))
    return (F.col("h1") != F.col("g1")) & once & packed_near(F.col("letters"), F.col("others"), edits)


def near_pairs(
    docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, equal_chars: int = MIN_CHARS
) -> tuple[DataFrame, DataFrame]:
    """Classes of equal lines (h1, h2, n, doc_id, tag, pos of the first one) and the linked ones (first place of both)."""
    lines = _lines(docs, min(min_chars, equal_chars))
    first = F.min(F.struct("doc_id", "pos", "tag")).alias("first")
    classes = stage(lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), first).select("h1", "h2", "n", "first.*"), "lines")
    length = F.length("line")
    sized = _without_repeats(lines.where(length >= min_chars), classes).select("h1", "line", length.alias("length")).withColumn("letters", packed_counts(F.col("line"), F.col("length")))
    keys = _keyed(sized, edits, _places(edits), F.col("h1"), F.col("letters")).repartition("key")
    # keys of equal lines that are left give one entry of the index; as this is also where own keys are
    # told from the others, both sides of the join read one exchange
    index = keys.groupBy("key", "h1", "letters").agg(F.max("own").alias("own")).where("own")
    group = Window.partitionBy("key")
    index = index.withColumns({"n": F.count("*").over(group), "least": F.min("h1").over(group)})
    # a large group sends one line, which only names the key to the lines that probe it
    index = index.where((F.col("n") <= MOST_MET) | (F.col("h1") == F.col("least"))).withColumn("large", F.col("n") > MOST_MET)
    index = index.select("key", "h1", "letters", "large")
    probe = keys.select("key", F.col("h1").alias("g1"), F.col("letters").alias("others"), "own")
    met = index.join(probe, "key").where(F.col("large") | _may_meet(edits))
    only = lambda name: F.when(F.col("large"), F.col(name)).alias(name)
    a = F.when(F.col("large"), F.col("g1")).otherwise(F.least("h1", "g1")).alias("a")
    b = F.when(~F.col("large"), F.greatest("h1", "g1")).alias("b")
    met = stage(met.select(a, b, only("key"), only("others"), only("own")).distinct(), "met")
    pairs = met.where("b IS NOT NULL").select("a", "b")
    crowd = met.where("b IS NULL").select("key", F.col("a").alias("h1"), F.col("others").alias("letters"), "own")
    if not crowd.isEmpty():
        # only pairs that all characters and their neighbours leave room for come out of large groups
        texts = _texts(docs, classes, crowd.select("h1").distinct(), min_chars)
        bits = texts.select("h1", *(gram_bits(F.col("line"), q).alias(f"bits{q}") for q in GRAMS))
        # two lines of one hash, however rare, are left to the comparison of the texts
        bits = bits.groupBy("h1").agg(F.count("*").alias("lines"), *(F.min(f"bits{q}").alias(f"bits{q}") for q in GRAMS))
        bits = stage(bits.where("lines = 1").drop("lines"), "bits")
        crowd = stage(crowd.join(bits, "h1", "left"), "crowd")
        probe = crowd.drop("own").withColumnsRenamed({"h1": "g1", "letters": "others"} | {f"bits{q}": f"theirs{q}" for q in GRAMS})
        more = crowd.where("own").join(probe, "key").where(_may_meet(edits))
        for q in GRAMS:
            more = more.where(F.coalesce(grams_near(F.col(f"bits{q}"), F.col(f"theirs{q}"), q, edits), F.lit(True)))
        pairs = stage(pairs.union(more.select(F.least("h1", "g1").alias("a"), F.greatest("h1", "g1").alias("b"))).distinct(), "met")

    named = pairs.select(F.col("a").alias("h1")).union(pairs.select("b")).distinct()
    texts = _texts(docs, classes, named, min_chars)
    # first the pairs that the letters leave room for, then the edit distance of these
    counts = texts.select("h1", "h2", histogram(F.col("line")).alias("letters"))
    left = counts.select(F.col("h1").alias("a"), F.col("h2").alias("a2"), F.col("letters").alias("one"))
    right = counts.select(F.col("h1").alias("b"), F.col("h2").alias("b2"), F.col("letters").alias("two"))
    pairs = pairs.join(left, "a").join(right, "b").where(may_be_near(F.col("one"), F.col("two"), edits))
    pairs = stage(pairs.select("a", "a2", "b", "b2"), "pairs")
    left = texts.select(F.col("h1").alias("a"), F.col("h2").alias("a2"), F.col("line").alias("one"), F.struct("doc_id", "pos").alias("x"))
    right = texts.select(F.col("h1").alias("b"), F.col("h2").alias("b2"), F.col("line").alias("two"), F.struct("doc_id", "pos").alias("y"))
    both = pairs.join(left, ["a", "a2"]).join(right, ["b", "b2"])
    # the distance costs more than its input is long: spread it over all tasks
    both = both.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    near = both.where(edit_distance(F.col("one"), F.col("two"), edits) <= edits)
    later = F.when(F.col("x") < F.col("y"), F.struct(F.col("b").alias("h1"), F.col("b2").alias("h2")))
    later = later.otherwise(F.struct(F.col("a").alias("h1"), F.col("a2").alias("h2")))
    return classes, stage(near.select(later.alias("later")).select("later.*").distinct(), "later")


def removals(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, equal_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, tag, gone): positions of the lines to remove, for documents (doc_id, tag, text) that lose some."""
    classes, later = near_pairs(docs, edits, min_chars, equal_chars)
    marked = classes.join(later.withColumn("near", F.lit(True)), ["h1", "h2"], "left")
    marked = marked.where("near or n > 1").select("h1", "h2", "near", F.struct("doc_id", "pos").alias("first"))
    lines = _lines(docs, min(min_chars, equal_chars)).select("doc_id", "tag", "pos", "h1", "h2")
    gone = lines.join(marked, ["h1", "h2"]).where(F.col("near") | (F.struct("doc_id", "pos") != F.col("first")))
    gone = gone.groupBy("doc_id", "tag").agg(F.collect_set("pos").alias("gone"))
    return stage(gone, "gone")


def dedup(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, equal_chars: int | None = None) -> DataFrame:
    """The rows of docs without repeated and near-repeated lines; adds n_lines and n_removed.

    Lines are what newlines separate. Order is by doc_id, then by place. Of equal lines the first stays;
    a line within `edits` edits of a line whose first place is earlier goes wherever it stands. Lines of
    fewer than min_chars characters are near none; they go only as repeats, if they have equal_chars
    characters (min_chars if not given). All columns are kept (one named like an added column is
    replaced); a null text stays null and has no lines, an empty text has one. Rows without doc_id stay
    as they are and remove nothing. Rows that repeat doc_id and text count as one document and get the
    same result; other rows of that doc_id are judged by their own text.
    """
    columns = [name for name in docs.columns if name not in ("n_lines", "n_removed")]
    named = docs.select("doc_id", F.xxhash64("text").alias("tag"), "text").where("doc_id is not null and length(text) > 0")
    gone = removals(named, edits, min_chars, min_chars if equal_chars is None else equal_chars)
    ids = gone.select("doc_id").distinct()
    ids = _told(ids)
    mine = docs.select(*[f"`{name}`" for name in columns])
    hit = mine.join(ids, "doc_id", "left_semi").withColumn("__tag", F.xxhash64("text"))
    gone = gone.select(F.col("doc_id").alias("__doc"), F.col("tag").alias("__other"), F.col("gone").alias("__gone"))
    hit = hit.join(gone, (F.col("doc_id") == F.col("__doc")) & (F.col("__tag") == F.col("__other")), "left")
    split = F.split("text", "\n")
    kept = F.filter(split, lambda line, i: ~F.array_contains("__gone", i))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    lines = F.coalesce(F.size(split), F.lit(0)).cast("long")
    lines = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(lines)
    removed = F.coalesce(F.size("__gone"), F.lit(0)).cast("long")
    removed = F.when(F.col("__gone").isNull(), F.lit(0).cast("long")).otherwise(removed)
    hit = hit.select(
        *[text.alias("text") if name == "text" else F.col(f"`{name}`") for name in columns],
        lines.alias("n_lines"),
        removed.alias("n_removed"),
    )
    rest = mine.join(ids, "doc_id", "left_anti").select("*", lines.alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    return hit.unionByName(rest)
