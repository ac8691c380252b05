"""Benchmark decontamination by template windows, in DataFrame functions only.

Numbers, names and units become typed placeholders and the rest lower-case words, so a question whose
figures or names were changed keeps its template. Hashed template windows are joined; then the slots
of each matched pair must be consistent: equal values of the item stand for equal values in the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.tables import small
from wardline.session import staged

WINDOW = 8
#: Template words of an item that a text must hold in windows; shorter items need all but one of theirs, and
#: one of at most WINDOW words, which is a single window, all.
ENOUGH = 13
#: Runs of words that are written into the plan of the first filter at most.
PLAN_WORDS = 20_000

#: Units of measure and money, as words of their own after a number.
UNITS = ("km|m|cm|mm|mi|miles?|feet|foot|ft|inch|inches|kg|g|mg|lb|lbs|pounds?|tons?|l|ml|litres?|liters?|"
         "s|sec|seconds?|min|minutes?|h|hours?|days?|weeks?|months?|years?|percent|dollars?|euros?|cents?|usd|eur|kmh|mph|°c|°f")

NO_RUNS = "cast(array() as array<struct<at:int,n:int,window:bigint>>)"
_NUMBER, _NAME, _UNIT = "\u0001", "\u0002", "\u0003"  # mark the words that fill slots


def marked_text(text: Column) -> Column:
    """Lower-case words between blanks; numbers, units after them and capitalised words within a sentence
    carry a mark."""
    text = F.coalesce(text, F.lit(""))
    for mark in (_NUMBER, _NAME, _UNIT):
        text = F.replace(text, F.lit(mark), F.lit(" "))
    text = F.regexp_replace(text, r" (?<=[\p{L}\p{N},;] )(\p{Lu}\p{Ll}+)", f" {_NAME}$1")
    text = F.regexp_replace(text, r"\d+(?:[.,:/]\d+)*", f" {_NUMBER}$0 ")
    text = F.regexp_replace(text, f"(?i)({_NUMBER}[^ ]+ +)({UNITS}|%)(?![\\p{{L}}\\p{{N}}])", f"$1{_UNIT}$2 ")
    text = F.regexp_replace(F.lower(text), f"[^\\p{{L}}\\p{{M}}\\p{{N}}{_NUMBER}-{_UNIT}%°.,:/]+|[.,:/]+(?!\\d)|(?<!\\d)[.,:/]+", " ")
    return F.trim(F.regexp_replace(text, "  +", " "))


def template(marked: Column) -> Column:
    """The text with every slot's value left out, its type kept."""
    return F.regexp_replace(marked, f"([{_NUMBER}-{_UNIT}])[^ ]+", "$1")


def words_of(marked: Column) -> Column:
    return F.when(marked == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(marked, " "))


def bound(value: Column, then) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` names it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _hashed(template_words: Column, marked: Column, at: Column, size, by_value: bool = True) -> Column:
    """The hash of a window's template words, or of its words with their values where all are slots."""
    plain = F.slice(template_words, at, size)
    if not by_value:
        return F.xxhash64(plain)
    return F.when(F.exists(plain, lambda x: x >= "\u0004"), F.xxhash64(plain)).otherwise(F.xxhash64(F.slice(marked, at, size), F.lit(1)))


def windows(marked: Column, size: int = WINDOW) -> Column:
    """``(at, n, window)`` of an item's runs of ``size`` words; an item of fewer words is one run, none has none."""
    def runs(t, w):
        n = F.least(F.size(w), F.lit(size))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - size + 1, F.lit(1))), lambda i: F.struct(
            (i - 1).alias("at"), n.alias("n"), _hashed(t, w, i, size).alias("window")))
    return F.when(marked == "", F.expr(NO_RUNS)).otherwise(
        bound(words_of(template(marked)), lambda t: bound(words_of(marked), lambda w: runs(t, w))))


def windows_of_sizes(marked: Column, sizes: list[int], by_value: bool) -> Column:
    """``(at, n, window)`` of a text's runs of each of ``sizes`` words; a text of fewer words has none of that size.
    ``by_value``: whether runs of slots only are hashed with their values, else by their template as all."""
    def runs(t, w, n):
        return F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.size(t) - n + 1, F.lit(1))), lambda i: F.struct(
            (i - 1).alias("at"), F.lit(n).alias("n"), _hashed(t, w, i, n, by_value).alias("window")))).otherwise(F.expr(NO_RUNS))
    def of(t, w):
        return F.concat(*[runs(t, w, n) for n in sizes])
    if not by_value:
        return bound(words_of(template(marked)), lambda t: of(t, None))
    return bound(words_of(template(marked)), lambda t: bound(words_of(marked), lambda w: of(t, w)))


def _run(words: Column, at: Column, n: int) -> list[Column]:
    return [F.try_element_at(words, at + k) for k in range(n)]


def _may_hold(spots: DataFrame, text: Column) -> Column:
    """Whether a text has the chosen words of any window, side by side.

    Chosen are three words of letters, or two or one where a window has no more, whose shortest is the longest,
    as they are rare elsewhere. Where they are too many for a plan, or a window has none, every text may
    hold an item.
    """
    def best(n):
        def run(i):
            words = _run(F.col("theirs"), i, n)
            return F.struct(F.array_min(F.transform(F.array(*words), F.length)).alias("size"), F.concat_ws(" ", *words).alias("words"), words[-1].alias("last"))
        runs = F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.size("theirs") - n + 1, F.lit(1))), run),
                        lambda r: r["last"].isNotNull() & r["words"].rlike(r"^[\p{L}\p{M} ]+$"))
        return F.array_max(runs)["words"]

    chosen = (spots.select(F.coalesce(best(3), best(2), best(1)).alias("words")).distinct().limit(PLAN_WORDS + 1).collect())
    if len(chosen) > PLAN_WORDS or any(r["words"] is None for r in chosen):
        return F.lit(True)
    runs = sorted(r["words"] for r in chosen)
    lengths = sorted({r.count(" ") + 1 for r in runs}) or [1]
    firsts = sorted({r.split(" ")[0] for r in runs})
    return bound(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}]+"), lambda w: F.exists(
        F.sequence(F.lit(1), F.size(w)), lambda i: F.element_at(w, i).isin(firsts) & reduce(
            Column.__or__, [F.concat_ws(" ", *_run(w, i, n)).isin(runs) for n in lengths])))


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
          item_text: str = "text", size: int = WINDOW, enough: int = ENOUGH) -> DataFrame:
    """``(key, item_key, n_words, n_changed)`` of every text that holds a benchmark item.

    A text holds an item when, along one alignment of the two, matched windows cover ``enough`` of the
    item's template words (in an item of no more words than that all but one; one of at most ``size`` words
    must stand there whole, anywhere in the text), and the slots under those windows are consistent: one value of the item is always one value of the text. A window is matched by its template if it has
    a literal word, and by its values if it is slots only, as any row of numbers has that template. ``n_changed`` counts slots whose
    value differs. Null and empty texts and items match nothing; repeated rows of a key count as one
    text each and give one row together; a null key is kept as null. Other columns are not read.

    Nearly every window has literal words side by side, so texts without the words chosen of any window are left
    out at once. The others' windows, of ``size`` words and of each shorter item's length, are hashed and joined;
    the few texts with matches are read again for the words under them.
    """
    wanted = items.select(F.col(item_key).alias("item"), marked_text(F.col(item_text)).alias("marked"))
    spots = (wanted.select("item", words_of(F.col("marked")).alias("item_words"), F.inline(windows(F.col("marked"), size)))
             .select("item", F.col("at").alias("item_at"), "n", "window", F.slice("item_words", F.col("at") + 1, size).alias("theirs"),
                     F.size("item_words").alias("item_size")))
    spots = staged(spots, "spots")
    index = small(spots.select("window").distinct())
    kinds = spots.select("n", F.forall("theirs", lambda x: x < "\u0004").alias("slots_only")).distinct().collect()
    sizes, by_value = sorted({r["n"] for r in kinds}) or [size], any(r["slots_only"] for r in kinds)
    # A text goes by its key and a hash, as keys may repeat or be null.
    texts = docs.where(_may_hold(spots, F.col(text))).select(F.col(key).alias("doc"), F.xxhash64(text).alias("copy"), F.col(text).alias("text"))
    hits = (texts.select("doc", "copy", F.inline(windows_of_sizes(marked_text(F.col("text")), sizes, by_value)))
            .join(index, "window").groupBy("doc", "copy").agg(F.collect_set(F.struct("at", "n", "window")).alias("hits")))
    hits = staged(hits.withColumn("doc_or", F.coalesce(F.col("doc").cast("string"), F.lit(""))), "hits")
    met = small(hits.select("doc_or", "copy").distinct())
    again = (texts.withColumn("doc_or", F.coalesce(F.col("doc").cast("string"), F.lit(""))).join(met, ["doc_or", "copy"], "left_semi")
             .groupBy("doc_or", "copy").agg(F.first("text").alias("text"))
             .select("doc_or", "copy", words_of(marked_text(F.col("text"))).alias("words")))
    found = (hits.join(again, ["doc_or", "copy"])
             .select("doc", "copy", F.explode(F.transform("hits", lambda h: F.struct(h["at"].alias("at"), h["window"].alias("window"),
                     F.slice("words", h["at"] + 1, h["n"]).alias("ours")))).alias("h")).select("doc", "copy", "h.*"))
    pairs = found.join(small(spots.drop("n"), 100_000), "window").where(F.size("ours") == F.size("theirs"))
    aligned = pairs.groupBy("doc", "copy", "item", "item_size", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.array_distinct(F.flatten(F.collect_list(F.transform(
            F.sequence(F.lit(0), F.size("ours") - 1),
            lambda i: F.struct((F.col("item_at") + i).alias("at"), F.element_at("theirs", i + 1).alias("theirs"),
                               F.element_at("ours", i + 1).alias("ours")))))).alias("places"))
    slots = F.array_distinct(F.transform(F.filter("places", lambda p: p["theirs"] < "\u0004"),
                                         lambda p: F.struct(p["theirs"].alias("theirs"), p["ours"].alias("ours"))))
    judged = aligned.withColumn("slots", slots).where(
        (F.size("places") >= F.least(F.lit(enough), F.greatest(F.col("item_size") - 1, F.lit(1))))
        & (F.size(F.array_distinct(F.transform("slots", lambda s: s["theirs"]))) == F.size("slots")))
    changed = F.size(F.filter("slots", lambda s: s["theirs"] != s["ours"]))
    return (judged.groupBy("doc", "item").agg(F.max(F.size("places")).alias("n_words"), F.min(changed).alias("n_changed"))
            .select(F.col("doc").alias(key), F.col("item").alias(item_key), "n_words", "n_changed"))
