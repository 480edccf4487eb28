"""Removal of lines that an earlier line matches up to one word edit.

Lines are compared as sequences of words.  A line goes if a line before it, by
document id and then line number, is equal, or if both have ``least_words`` or
more and one word inserted, deleted or replaced turns one into the other.  Lines
without words stay.

Near lines meet by their deletion neighbourhood: every line gives the hashes of
itself and of itself less each word, each the XOR of hashes of a word and its
place, so that all of a line's come from running XORs over its words.  Two lines
of a replaced word share the variant without that word's place; a line with an
inserted word has a variant that equals the other line.  No pairs of lines are made: a variant needs only its
earliest line, and that line's words verify it.  Before that, lines pass only
that share their first or last half with another; one of the two halves is whole
in near lines.  All of it is DataFrame functions.

A null or empty text has one line without words.  Null ids come first.  Rows
equal in id and text count as one document and get the same result.  Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.scratch import stored

LEAST_WORDS = 8


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, r"[\x20\x09-\x0D]+"), "")


def _lines(rows: DataFrame) -> DataFrame:
    return rows.select("id", "name", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "line")).withColumn("words", _words(F.col("line"))).withColumn("n", F.size("words")).where("n > 0")


def _halves() -> Column:
    """Hashes of the first and last half, as lines of n words and of n + 1 words share them with a near line of the same or one word less."""

    def half(m: Column) -> list[Column]:
        k = F.floor((m - 1) / 2).cast("int")
        return [F.xxhash64(F.lit(side), m, F.slice("words", start, k)) for side, start in (("first", F.lit(1)), ("last", F.col("n") - k + 1))]

    return F.array(*half(F.col("n")), *half(F.col("n") + 1))


def distinct_lines(rows: DataFrame, least_words: int) -> DataFrame:
    """Every different line once: two hashes, its first place, and the keys of its halves (none for short lines)."""
    halves = F.when(F.col("n") >= least_words, _halves())
    lines = _lines(rows).select(F.xxhash64("words").alias("h1"), F.xxhash64(F.lit("other"), "words").alias("h2"), F.struct("id", "name", "line_no").alias("place"), halves.alias("halves"))
    return lines.groupBy("h1", "h2").agg(F.min("place").alias("place"), F.first("halves").alias("halves"))


def _xors(name: str, *salt: Column) -> list[Column]:
    """For the first 0, 1, ... words, the XOR of the hashes of each word with its place (here), and with the place before it (back).

    A line's hash is all of ``here``; less the word at a cut it is what ``here`` has before the cut and ``back`` after it."""

    def running(shift: int) -> Column:
        placed = F.transform("words", lambda w, i: F.xxhash64(*salt, w, i - shift))
        return F.aggregate(placed, F.array(F.lit(0).cast("long")), lambda so_far, x: F.array_append(so_far, F.element_at(so_far, -1).bitwiseXOR(x)))

    return [running(0).alias(f"here{name}"), running(1).alias(f"back{name}")]


def near_earlier(lines: DataFrame) -> DataFrame:
    """``(h1, h2)`` of the lines of ``lines(h1, h2, place, words)`` that have an earlier line within one word edit."""
    n = F.size("words")
    hashed = lines.select("*", *_xors("1"), *_xors("2", F.lit("other")))
    cuts = hashed.withColumn("cut", F.explode(F.sequence(F.lit(0), n)))
    without = [F.get(f"here{k}", F.col("cut") - 1).bitwiseXOR(F.get(f"back{k}", F.col("cut"))).bitwiseXOR(F.get(f"back{k}", n)) for k in (1, 2)]
    # a cut of 0 leaves the line whole
    variants = [F.when(F.col("cut") == 0, F.get(f"here{k}", n)).otherwise(v).alias(f"v{k}") for k, v in enumerate(without, 1)]
    variants = stored(cuts.select("h1", "h2", "place", "cut", *variants), "line-variants")
    cuts = variants.where("cut > 0")
    both = ["v1", "v2"]
    # one word replaced: the same variant, cut at the same place
    replaced = cuts.groupBy(*both, "cut").agg(F.min("place").alias("least"), F.min(F.struct("place", "h1", "h2")).alias("by"), F.count("*").alias("lines")).where("lines > 1").select(*both, "cut", "least", "by.h1", "by.h2")
    whole = variants.where("cut = 0").select(*both, "cut", F.col("place").alias("least"), "h1", "h2")
    met = cuts.alias("c").join(replaced.union(whole).alias("g"), both).where("(g.cut = 0 OR g.cut = c.cut) AND g.least != c.place")
    later = F.when(F.expr("g.least < c.place"), F.struct("c.h1", "c.h2", F.col("g.h1").alias("e1"), F.col("g.h2").alias("e2"))).when(F.expr("g.cut = 0"), F.struct("g.h1", "g.h2", F.col("c.h1").alias("e1"), F.col("c.h2").alias("e2")))
    found = met.select(later.alias("found")).where("found IS NOT NULL").select("found.*").distinct()
    # the words themselves: equal but for one place, or but for one word more
    words = lines.select("h1", "h2", "words")
    pairs = found.join(words, ["h1", "h2"]).join(words.select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("words").alias("other")), ["e1", "e2"])
    return pairs.where(within_one_edit("words", "other")).select("h1", "h2").distinct()


def within_one_edit(left: str, right: str) -> Column:
    """At most one word inserted, deleted or replaced."""
    a, b = F.col(left), F.col(right)
    short, long = F.when(F.size(a) <= F.size(b), a).otherwise(b), F.when(F.size(a) <= F.size(b), b).otherwise(a)
    head = F.size(short) - F.coalesce(F.array_max(F.transform(F.filter(F.sequence(F.lit(1), F.size(short)), lambda i: F.get(short, i - 1) != F.get(long, i - 1)), lambda i: F.size(short) - i + 1)), F.lit(0))
    rest_long = F.slice(long, head + 2, F.size(long))
    rest_short = F.when(F.size(short) == F.size(long), F.slice(short, head + 2, F.size(short))).otherwise(F.slice(short, head + 1, F.size(short)))
    return (F.size(long) - F.size(short) <= 1) & (rest_long == rest_short)


def line_decisions(docs: DataFrame, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its number of lines and the numbers, from 0, of those that go."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("name"), F.col(text_col).alias("text"))
    lines = stored(distinct_lines(rows, least_words), "distinct-lines")
    keys = lines.where("halves IS NOT NULL").select("h1", "h2", F.explode("halves").alias("half"))
    shared = keys.groupBy("half").agg(F.count("*").alias("lines")).where("lines > 1").select("half")
    able = stored(keys.join(shared, "half").select("h1", "h2").distinct().join(lines.select("h1", "h2", "place"), ["h1", "h2"]), "able-lines")
    places = able.select("h1", "h2", "place", F.col("place.id").alias("p_id"), F.col("place.name").alias("p_name"), F.col("place.line_no").alias("p_line"))
    wanted = places.groupBy("p_id", "p_name").agg(F.collect_list(F.struct("p_line", "h1", "h2", "place")).alias("lines"))
    same = rows["id"].eqNullSafe(wanted["p_id"]) & (rows["name"] == wanted["p_name"])
    texts = rows.join(wanted, same).dropDuplicates(["id", "name"])
    split = texts.select("lines", F.split(F.coalesce("text", F.lit("")), "\n").alias("all")).select(F.explode("lines").alias("l"), "all")
    with_words = stored(split.select("l.h1", "l.h2", "l.place", _words(F.get("all", F.col("l.p_line"))).alias("words")), "able-words")
    near = near_earlier(with_words)
    kept = lines.join(near, ["h1", "h2"], "left_anti").select("place.id", "place.name", "place.line_no")
    kept = kept.groupBy("id", "name").agg(F.collect_list("line_no").alias("kept"))
    split = F.split(F.coalesce("text", F.lit("")), "\n")
    numbers = F.filter(F.transform(split, lambda line, i: F.when(line.rlike(r"[^\x20\x09-\x0D]"), i)), lambda i: i.isNotNull())
    per = rows.select("id", "name", F.size(split).alias("n_lines"), numbers.alias("full"))
    out = per.alias("d").join(kept.alias("k"), F.expr("d.id <=> k.id AND d.name = k.name"), "left")
    gone = F.array_sort(F.array_except("d.full", F.coalesce("k.kept", F.array().cast("array<int>"))))
    return out.select(F.col("d.id").alias("doc_id"), F.col("d.n_lines").cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_removed"), gone.alias("removed"))


def without_lines(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, whose ids must differ, with the decided lines cut out of the texts."""
    gone = decisions.select(F.col("doc_id").alias(id_col), F.col("removed").alias("__removed"))
    kept = F.filter(F.split(text_col, "\n"), lambda line, i: ~F.array_contains("__removed", i))
    return docs.join(gone, id_col).withColumn(text_col, F.array_join(kept, "\n")).select(*docs.columns)
