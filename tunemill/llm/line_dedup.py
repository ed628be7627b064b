"""Near-duplicate lines by an exact set-similarity join, in DataFrame operations only.

The tokens of a line are its different words. Two lines match if their token sets have a Jaccard
similarity of 0.8 or more. A line is removed if a line before it (smaller doc_id, or higher up in the same
document) matches it. Lines without words match nothing.

1. Rarity. The occurrences of all words are counted in 2^20 slots, picked by the word's hash; a token is a
   number made of its slot's class (eight classes for each doubling of the count) and 55 bits of its hash. Any
   order of tokens gives exact results.
2. Prefixes. Of lines with equal sets, by 128 bits of hashes, all but the first go; the first stands for them. The n - ceil(0.8 n) + 1 rarest tokens of a set are
   listed; matching sets have a listed token in common.
3. Filters, on pairs that meet in a token: length (5 * smaller >= 4 * larger), position (what is left of both
   lists behind the token must suffice) and sketch. A sketch is 128 bits, each the parity of the
   tokens hashed to it: it differs in one bit at most for each token that only one set has. Sets of up to 48
   tokens use 64 bits; the two halves of a longer sketch, combined by XOR, are its 64-bit sketch.
4. Check. Pairs that are left are compared word by word. Only lines that occur in a pair travel: others are
   left out by a bitmap of hashed keys (eight bits a key, 2^24 at most), which may let through too many but never too few.

Before all others, lines are tried against the first line that has the same smallest, or largest, hash among its
listed tokens, by two hashes. Lines that match it need no other partner, so a line copied with small changes a
million times makes a few million pairs, not the square. All others meet all their partners.

A null text has no lines and stays null. Lines of a row with a null id are kept and remove
nothing. Rows that repeat an id are one document: their lines are numbered alike, and what goes in
one of them goes in all. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import SPACE, discard, stored

WORD = r"[^\x20\x09-\x0D]"
SLOT_BITS = 20
#: A bitmap has some bits a key, within bounds that are powers of two.
BITS_A_KEY, LEAST_BITMAP, BITMAP_BITS = 8, 12, 24
HASH_BITS = 55
#: Sets of more tokens than this use both halves of the sketch.
SHORT = 48
SKETCH = ["s0", "s1"]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def slot_counts(docs: DataFrame) -> DataFrame:
    """One row, one column `slots`: class of the occurrences of words, by the first bits of their hash, eight classes in a long."""
    words = docs.select(F.explode(F.split("text", SPACE)).alias("word")).where("word <> ''")
    slot = F.shiftrightunsigned(F.xxhash64("word"), 64 - SLOT_BITS)
    return packed_classes(words.groupBy(slot.alias("slot")).agg(F.count("*").alias("n")))


def packed_classes(counts: DataFrame) -> DataFrame:
    """One row, one column `slots`: classes of the counts (slot, n), eight in a long."""
    step = F.least(F.floor(8 * F.log2(1 + F.col("n"))), F.lit(255)).cast("long")
    steps = counts.select(F.shiftright("slot", 3).alias("id"), F.expr("CAST(slot & 7 AS INT) * 8").alias("at"), step.alias("step"))
    packed = steps.select("id", F.expr("shiftleft(step, at)").alias("steps"))
    every = counts.sparkSession.range(0, 1 << (SLOT_BITS - 3), 1, 1).select("id", F.lit(0).cast("long").alias("steps"))
    whole = packed.union(every).groupBy("id").agg(F.bit_or("steps").alias("steps"))
    # A long per eight slots: at most 2^17, whatever the size of the corpus.
    return whole.agg(F.sort_array(F.collect_list(F.struct("id", "steps")))["steps"].alias("slots"))


def slot_class(table: Column, h: Column) -> Column:
    """The class of a hash's slot."""
    steps = F.coalesce(table[F.shiftrightunsigned(h, 67 - SLOT_BITS).cast("int")], F.lit(0).cast("long"))
    at = F.shiftrightunsigned(h, 64 - SLOT_BITS).bitwiseAND(F.lit(7)).cast("int") * 8
    return F.call_function("shiftrightunsigned", steps, at).bitwiseAND(F.lit(255).cast("long"))


def line_keys(docs: DataFrame) -> tuple[int, str]:
    """Bits for the line number and type of the number that puts all lines in order."""
    low, high, longest = docs.agg(F.min("doc_id"), F.max("doc_id"), F.max(F.octet_length("text"))).first()
    bits = max(longest or 1, 1).bit_length()
    fits = max(abs(low or 0), abs(high or 0)) < 1 << (62 - bits) if bits < 62 else False
    return bits, "bigint" if fits else "decimal(38,0)"


def token_sets(docs: DataFrame, slots: DataFrame, bits: int, kind: str) -> DataFrame:
    """key, tokens (numbers of the line's different words, rarest first) and name for each line with words.

    `name` is a hash of the words themselves in order: lines count as equal sets only if it agrees too, so words that share
    a token don't make their lines equal.
    """
    lines = docs.where("doc_id IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    # Decided on the line: a condition on the tokens would be worked out apart from them, once more.
    lines = lines.where(F.col("line").rlike(WORD))

    words = F.array_distinct(words_of(F.col("line")))

    def coded(table: Column) -> Column:
        def token(h: Column) -> Column:
            return F.shiftleft(slot_class(table, h), HASH_BITS).bitwiseOR(h.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))

        return F.sort_array(F.transform(F.transform("words", lambda word: F.xxhash64(word)), token))

    key = _key(F.col("doc_id"), F.col("line_no"), bits, kind)
    name = F.xxhash64(F.lit("name"), F.sort_array("words"))
    cut = lines.select(key.alias("key"), words.alias("words")).select("key", "words", name.alias("name"))
    # One select after the subquery column that uses `words` once, so that the two merge and the array isn't copied into each row.
    return (
        cut.withColumn("_slots", slots.scalar())
        .select("key", F.transform(F.array("_slots"), coded)[0].alias("tokens"), "name")
    )


def described(sets: DataFrame) -> DataFrame:
    """key, the set's identity (set_hash, name, n), its sketch and its prefix."""

    def half(number: int) -> Column:
        bit = "shiftleft(1L, CAST(t & 63 AS INT))"
        short = "0L" if number else f"aggregate(tokens, 0L, (bits, t) -> bits ^ {bit})"
        long = f"aggregate(tokens, 0L, (bits, t) -> IF((t & 64) = {64 * number}, bits ^ {bit}, bits))"
        return F.expr(f"IF(size(tokens) > {SHORT}, {long}, {short})")

    return sets.select(
        "key",
        F.xxhash64("tokens").alias("set_hash"),
        "name",
        F.size("tokens").alias("n"),
        *[half(number).alias(column) for number, column in enumerate(SKETCH)],
        F.expr("slice(tokens, 1, size(tokens) - (4 * size(tokens) + 4) div 5 + 1)").alias("prefix"),
    )


IDENTITY = ["set_hash", "name", "n"]


def listed(sets: DataFrame) -> DataFrame:
    """token, spot (place in the list, doubled, and 1 for open lines), first line (key) and sketch of each set of four tokens or more.

    Smaller sets match equal ones only.
    """
    rows = sets.where("n > 3").select("key", "n", *SKETCH, "open", F.posexplode("prefix").alias("pos", "token"))
    return rows.select("key", "n", *SKETCH, F.expr("2 * pos + IF(open, 1, 0)").alias("spot"), "token")


def _may_match(x: str, y: str, differing: str, pos: str = "{}.pos") -> Column:
    """Whether `y` comes before `x` and passes the filters; `differing` counts the differing bits of their sketches."""
    x_pos, y_pos = pos.format(x), pos.format(y)
    common = f"((4 * ({x}.n + {y}.n) + 8) div 9)"
    return F.expr(
        f"{y}.key < {x}.key AND 5 * least({x}.n, {y}.n) >= 4 * greatest({x}.n, {y}.n)"
        f" AND least({x}.n - {x_pos}, {y}.n - {y_pos}) >= {common}"
        f" AND {differing} <= {x}.n + {y}.n - 2 * {common}"
    )


def first_partners(sets: DataFrame) -> DataFrame:
    """x, y: lines and the first line that has the same smallest or largest hash among the listed tokens, by two hashes."""
    hashes = [F.transform("prefix", lambda token: F.xxhash64(token)), F.transform("prefix", lambda token: F.xxhash64(token, F.lit(1)))]
    rows = sets.where("n > 3").select("key", "n", F.expr(" ^ ".join(SKETCH)).alias("bits"), F.lit(0).alias("pos"), F.array(*hashes).alias("hashes"))
    ends = F.array(*[end(F.col("hashes")[k]) for k in range(len(hashes)) for end in (F.array_min, F.array_max)])
    rows = rows.select("key", "n", "bits", "pos", F.explode(ends).alias("mark"))
    first = rows.groupBy("mark").agg(
        F.min("key").alias("key"), *[F.min_by(name, "key").alias(name) for name in ("n", "bits", "pos")]
    )
    near = _may_match("x", "y", "bit_count(x.bits ^ y.bits)")
    pairs = rows.alias("x").join(first.alias("y"), F.expr("x.mark = y.mark") & near)
    return pairs.select(F.col("x.key").alias("x"), F.col("y.key").alias("y")).distinct()


def all_partners(entries: DataFrame) -> DataFrame:
    """x, y: lines that are open and all lines before them that may match.

    Both sides are the same table, column by column, so that Spark deals it out once. For that, whether a line is open lies in
    a column that both sides need, and is asked in a condition on both: a condition on one is moved below the shuffle.
    """
    whole = " + ".join(f"bit_count(x.{half} ^ y.{half})" for half in SKETCH)
    folded = " ^ ".join(f"{side}.{half}" for side in ("x", "y") for half in SKETCH)
    differing = f"IF(x.spot & 1 = 0, {(1 << 31) - 1}, IF(least(x.n, y.n) > {SHORT}, {whole}, bit_count({folded})))"
    near = _may_match("x", "y", differing, "shiftright({}.spot, 1)")
    pairs = entries.alias("x").join(entries.alias("y"), F.expr("x.token = y.token") & near)
    return pairs.select(F.col("x.key").alias("x"), F.col("y.key").alias("y")).distinct()


def bitmap(values: DataFrame, column: str, keys: int | None = None) -> DataFrame:
    """One row, one column `bits`: bits as longs, set where a value's hash points to.

    There are 2^BITMAP_BITS bits, or as many as `keys`, the number of values, need.
    """
    width = BITMAP_BITS if keys is None else min(max(LEAST_BITMAP, (BITS_A_KEY * keys).bit_length()), BITMAP_BITS)
    place = F.xxhash64(column).bitwiseAND(F.lit((1 << width) - 1))
    bit = F.expr("shiftleft(1L, CAST(place & 63 AS INT))")
    words = values.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("id")).agg(F.bit_or(bit).alias("bits"))
    every = values.sparkSession.range(0, 1 << (width - 6), 1, 1).select("id", F.lit(0).cast("long").alias("bits"))
    whole = words.union(every).groupBy("id").agg(F.bit_or("bits").alias("bits"))
    return whole.agg(F.sort_array(F.collect_list(F.struct("id", "bits")))["bits"].alias("bits"))


def stored_bitmap(table: DataFrame, column: str) -> DataFrame:
    """The bitmap of a column of a stored table, stored."""
    return stored(bitmap(table, column, table.count()), "bitmap")


def maybe_in(bits: Column, value: Column) -> Column:
    place = F.xxhash64(value).bitwiseAND(F.size(bits).cast("long") * 64 - 1)
    word = bits[F.shiftright(place, 6).cast("int")]
    return F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1


def _key(doc_id: Column, line_no: Column, bits: int, kind: str) -> Column:
    return (doc_id.cast(kind) * F.lit(1 << bits).cast(kind) + line_no.cast(kind)).cast(kind)


def _place(bits: int, kind: str) -> tuple[Column, Column]:
    """doc_id and line number of a key."""
    if kind == "bigint":
        return F.shiftright("key", bits), F.col("key").bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    doc_id = F.expr(f"CAST(floor(key / {1 << bits}BD) AS BIGINT)")
    return doc_id, (F.col("key") - doc_id.cast(kind) * F.lit(1 << bits).cast(kind)).cast("int")


def matching(pairs: DataFrame, docs: DataFrame, bits: int, kind: str) -> DataFrame:
    """x of the pairs whose lines' sets of words have a Jaccard similarity of 0.8 or more."""
    pairs = stored(pairs, "pairs")
    lines = docs.where("doc_id IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    lines = lines.select(_key(F.col("doc_id"), F.col("line_no"), bits, kind).alias("key"), "line")

    wanted = {end: stored_bitmap(pairs, end) for end in ("x", "y")}

    def side(end: str) -> DataFrame:
        there = lines.withColumn("_bits", wanted[end].scalar()).where(maybe_in(F.col("_bits"), F.col("key")))
        return there.select(F.col("key").alias(end), F.col("line").alias(f"{end}_line"))

    both = pairs.join(side("x"), "x").join(side("y"), "y")
    x_words, y_words = (F.array_distinct(words_of(F.col(line))) for line in ("x_line", "y_line"))

    def alike(pair: Column) -> Column:
        common = F.size(F.array_intersect(pair["a"], pair["b"]))
        return 9 * common >= 4 * (F.size(pair["a"]) + F.size(pair["b"]))

    # As one argument of a function, the sets of words are worked out once for each pair.
    sets = F.array(F.struct(x_words.alias("a"), y_words.alias("b")))
    found = stored(both.where(F.transform(sets, alike)[0]).select("x").distinct(), "matching")
    discard(pairs, *wanted.values())
    return found


def repeats(lines: DataFrame) -> DataFrame:
    """key of the lines whose set of words an earlier line has. A stored table."""
    groups = lines.groupBy(*IDENTITY).agg(F.min("key").alias("first_key"), F.count("*").alias("times"))
    several = stored(groups.where("times > 1").drop("times"), "several")
    bits = stored_bitmap(several, "set_hash")
    # Lines of sets that occur once, as the bitmap shows, don't travel.
    there = lines.select("key", *IDENTITY).withColumn("_bits", bits.scalar()).where(maybe_in(F.col("_bits"), F.col("set_hash")))
    later = stored(there.drop("_bits").join(several, IDENTITY).where("key > first_key").select("key"), "repeats")
    discard(several, bits)
    return later


def _marked(lines: DataFrame, bits: DataFrame) -> DataFrame:
    return lines.withColumn("_bits", bits.scalar()).withColumn("_maybe", maybe_in(F.col("_bits"), F.col("key"))).drop("_bits")


def without(lines: DataFrame, keys: DataFrame, bits: DataFrame) -> DataFrame:
    """The rows of `lines` whose key isn't in `keys`; those that the bitmap of the keys lacks don't travel."""
    marked = _marked(lines, bits)
    rest = marked.where("_maybe").join(keys, "key", "left_anti")
    return marked.where("NOT _maybe").unionByName(rest).drop("_maybe")


def flagged(lines: DataFrame, settled: DataFrame, bits: DataFrame) -> DataFrame:
    """`lines` and `open`, whether their key isn't in `settled` (keys); those that the bitmap of the keys lacks don't travel."""
    marked = _marked(lines, bits)
    found = marked.where("_maybe").join(settled.withColumn("settled", F.lit(True)), "key", "left")
    found = found.withColumn("open", F.col("settled").isNull()).drop("settled")
    return marked.where("NOT _maybe").withColumn("open", F.lit(True)).unionByName(found).drop("_maybe")


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, removed (numbers of the lines that go, from 0) of the documents that lose some. A stored table."""
    bits, kind = line_keys(docs)
    slots = stored(slot_counts(docs), "slots")
    lines = stored(described(token_sets(docs, slots, bits, kind)), "lines")
    later = repeats(lines)
    seen = stored_bitmap(later, "key")
    sets = without(lines, later, seen)
    early = matching(first_partners(sets), docs, bits, kind)
    settled = early.select(F.col("x").alias("key"))
    there = stored_bitmap(early, "x")
    late = matching(all_partners(listed(flagged(sets, settled, there))), docs, bits, kind)
    # A line that repeats an earlier one goes anyway, so what goes of a set is known without its other lines.
    gone = later.union(early).union(late)
    doc_id, line_no = _place(bits, kind)
    removed = stored(gone.groupBy(doc_id.alias("doc_id")).agg(F.collect_set(line_no).alias("removed")), "removed")
    discard(slots, lines, later, seen, early, there, late)
    return removed


def without_lines(docs: DataFrame) -> DataFrame:
    """The columns of `docs`, with `_lines` before and `_kept` after the removal.

    Documents that lose no line, as a bitmap of the others shows, don't travel.
    """
    removed = removed_lines(docs)
    losing = stored_bitmap(removed, "doc_id")
    marked = docs.withColumn("_bits", losing.scalar()).select(
        *[F.col(f"`{c}`") for c in docs.columns], maybe_in(F.col("_bits"), F.col("doc_id")).alias("_loses")
    )
    still = marked.where("NOT coalesce(_loses, FALSE)").drop("_loses").withColumn("removed", F.lit(None).cast("array<int>"))
    moved = marked.where("_loses").drop("_loses").join(removed, "doc_id", "left").select(*[F.col(f"`{c}`") for c in docs.columns], "removed")
    rows = still.union(moved).withColumn("_lines", F.split("text", "\n", -1))
    numbers = F.sequence(F.lit(0), F.size("_lines") - 1)
    kept = F.transform(F.array_except(numbers, "removed"), lambda number: F.col("_lines")[number])
    return rows.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        "_lines",
        F.when(F.col("removed").isNull() | F.col("_lines").isNull(), F.col("_lines")).otherwise(kept).alias("_kept"),
    )


def line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_text, kept_sha256 for each row; a null text has no lines."""
    rows = without_lines(docs.select("doc_id", "text"))
    text = F.array_join("_kept", "\n")
    before, after = F.coalesce(F.size("_lines"), F.lit(0)), F.coalesce(F.size("_kept"), F.lit(0))
    return rows.select(
        "doc_id",
        F.greatest(before, F.lit(0)).cast("long").alias("n_lines"),
        F.greatest(before - after, F.lit(0)).cast("long").alias("n_removed"),
        text.alias("kept_text"),
    ).withColumn("kept_sha256", F.sha2(F.coalesce("kept_text", F.lit("")), 256))


def drop_lines(docs: DataFrame) -> DataFrame:
    """`docs` with the lines removed from `text`, and `n_chars`, where there is one, counted anew."""
    rows = without_lines(docs).withColumn("_text", F.array_join("_kept", "\n"))
    return rows.select(
        *[
            F.col("_text").alias(c) if c == "text"
            else F.length("_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
            else F.col(f"`{c}`")
            for c in docs.columns
        ]
    )
