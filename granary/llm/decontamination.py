"""Benchmark decontamination by templates: questions are found again with other numbers, names and units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.session import stage

# Units of measure, as written after a number.
UNITS = ("km", "cm", "mm", "m", "kg", "mg", "g", "lb", "lbs", "oz", "l", "ml", "s", "ms", "min", "h", "hours", "hour", "minutes",
         "minute", "seconds", "second", "days", "day", "weeks", "years", "miles", "mile", "feet", "ft", "inches", "metres", "meters",
         "litres", "liters", "grams", "kilograms", "dollars", "euros", "cents", "usd", "eur", "percent", "mph", "kw", "w", "v", "hz", "gb", "mb")
_CAPITALISED = r"\p{Lu}[\p{Lu}'’-]*\p{Ll}[\p{L}'’-]*"
# Groups repeat possessively: Java's regex does that in a loop, else by a call deeper for each word, of which long runs have too many.
_RUN = rf"{_CAPITALISED}(?:\s+{_CAPITALISED})*+"
#: Capitalised words in a row, not all in capitals: after a word or comma (group 1), else as sentence opener (group 2).
_NAME = rf"(?=\p{{Lu}})(?:(?<=[^.!?:\s]\s{{1,4}})({_RUN})|({_RUN}))"
_OPEN, _OPENER, _CLOSE = "\ue000", "\ue002", "\ue001"  # private code points, which stand in no text
NUMBER, QUANTITY, NAME = "#n", "#q", "#e"
#: The two templates of an item: names as placeholders, and all words in lower case.
TYPED, FOLDED = 1, 0


def raw_tokens(text: Column) -> Column:
    """Words, numbers, quantities and names of a text in order, whatever white space is between them.

    A name is one or more capitalised words in a row, none of them in capitals
    throughout; it is given between two marks, with a third one behind it, or
    before it if it begins a sentence. A quantity is a number with the unit after it.
    """
    number = r"[0-9]+(?:[.,:/][0-9]+)*+"
    token = rf"{_OPEN}[^{_CLOSE}]*{_CLOSE}|{number}(?:\s?(?:{'|'.join(sorted(UNITS, key=len, reverse=True))})\b|%)?|\p{{L}}+"
    return F.regexp_extract_all(F.regexp_replace(text, _NAME, f"{_OPEN}$1{_OPENER}$2{_CLOSE}"), F.lit(token), F.lit(0))


def folded(raw: Column) -> Column:
    """Tokens in lower case, with names taken apart into their words."""
    parts = F.transform(raw, lambda t: F.when(t.startswith(_OPEN), F.array_remove(F.split(F.lower(t), r"[^\p{L}]+"), "")).otherwise(F.array(F.lower(t))))
    return F.flatten(parts)


def typed(token: Column) -> Column:
    """A token as it stands in a template: placeholders for names, quantities and numbers; words in lower case."""
    return (F.when(token < ":", F.when(token.rlike("[0-9]$"), NUMBER).otherwise(QUANTITY))
            .when(token.startswith(_OPEN), NAME)
            .otherwise(F.lower(token)))


def item_templates(items: DataFrame) -> DataFrame:
    """Two rows for each of ``items``, with ``kind``, ``raw`` and ``tokens`` instead of ``text``.

    The folded template is what a copy in small or in capital letters gives, in
    which no word is capitalised.
    """
    raw = items.withColumn("raw", raw_tokens(F.col("text"))).drop("text")
    both = F.array(F.struct(F.lit(TYPED).alias("kind"), F.col("raw")), F.struct(F.lit(FOLDED).alias("kind"), folded(F.col("raw")).alias("raw")))
    return raw.withColumn("each", F.explode(both)).drop("raw").select("*", "each.*").drop("each").withColumn("tokens", F.transform("raw", typed))


def with_windows(rows: DataFrame, width: int, hashes: Column, name: str = "keys") -> DataFrame:
    """``rows`` with the 64-bit hash of each ``width`` tokens in a row, from their own; ``width`` is a power of two.

    Hashes of windows twice as long are made of two of the shorter ones. Each
    doubling is a projection of its own, so that no array is worked out twice.
    """
    rows, step = rows.withColumn(name, hashes), 1
    while step < width:
        later = F.slice(name, step + 1, F.greatest(F.size(name) - step, F.lit(0)))
        rows = rows.withColumn(name, F.zip_with(name, later, lambda a, b: F.xxhash64(a, b)))
        step *= 2
    return rows.withColumn(name, F.slice(name, 1, F.greatest(F.size(name) - width + 1, F.lit(0))))  # those that are full


def _slot(token: Column) -> Column:
    return token.startswith("#")


def item_windows(items: DataFrame, width: int, least_words: int) -> DataFrame:
    """Windows of each item with at least ``least_words`` words that are no placeholders.

    Columns: item, variant (one of the texts of an item id), kind (which template),
    key, at, n (such windows of it) and raw (the window's tokens).
    """
    one = ["item", "variant", "kind"]
    rows = with_windows(items, width, F.transform("tokens", lambda t: F.xxhash64(t))).select(*one, "tokens", "raw", F.posexplode_outer("keys").alias("at", "key"))
    words = F.size(F.filter(F.slice("tokens", F.col("at") + 1, F.lit(width)), lambda t: ~_slot(t)))
    kept = rows.where(F.col("key").isNotNull() & (words >= least_words)).select(*one, "key", "at", F.slice("raw", F.col("at") + 1, F.lit(width)).alias("raw"))
    return kept.join(kept.groupBy(*one).agg(F.count("at").alias("n")), one)


def key_bits(windows: DataFrame, count: int, most_bits: int) -> list[int]:
    """Longs in which the lowest bits of every key name a bit that is set: 64 times as many bits as windows, at most ``most_bits``."""
    size = min(most_bits, 1 << (64 * max(count, 1) - 1).bit_length())
    word, bit = F.shiftright(F.col("key").bitwiseAND(size - 1), 6).cast("int"), F.expr("shiftleft(1L, cast(key & 63 as int))")
    found = windows.select(word.alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).collect()
    bits = [0] * (size // 64)
    for r in found:
        bits[r.w] = r.b
    return bits


def marked_places(keys: str, bits: list[int]) -> Column:
    """Where in an array of keys those stand whose bit is set."""
    # Text that Spark folds into one literal array, a thousand times quicker than a literal for each long.
    marks, size = F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>"), 64 * len(bits)

    def is_set(at: Column) -> Column:
        key = F.get(keys, at)
        return F.bit_get(F.get(marks, F.shiftright(key.bitwiseAND(size - 1), 6).cast("int")), key.bitwiseAND(63).cast("int")) == 1

    return F.filter(F.when(F.size(keys) > 0, F.sequence(F.lit(0), F.size(keys) - 1)), is_set)


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = 8, least_words: int = 4, coverage: float = 0.5, run: int = 13,
               slack: int = 32, most_bits: int = 1 << 22, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs of a document and a benchmark item that it holds, also with other numbers, names and units.

    Columns: id, item, coverage (share of the item's windows found along an
    alignment), slots (its placeholders there), exact (all slots have the item's
    values). An alignment may shift by up to half of ``slack`` tokens, for words
    put in or left out. A pair counts if ``coverage`` of the item's windows, or of
    its tokens and at least ``run`` of them, lie in matched windows, or if ``run``
    tokens in a row do.

    Items have two templates. In one, names (capitalised words, also those that
    begin sentences) are placeholders; there, each value of the item's slots in
    matched windows must stand for one value of the document's throughout, and
    different names for different ones, but for names that begin sentences. The
    other has names as words in lower case, as copies in small or in capital
    letters have them; it counts where the first finds nothing. Items themselves
    are taken to be in usual spelling. White space and line breaks make no
    difference.

    Windows are joined by hash, and only those whose hash is marked in a bit set
    of the benchmark's, of at most ``most_bits``, leave their document's row: with
    the tokens in them, so that no text is read twice or moved. Null or empty
    texts and null ids give no pair, and so do items without a window of
    ``width`` tokens, ``least_words`` of them words. Rows with the same id count
    as one document, and rows with the same item id as one item: the best
    alignment of any of them. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).where("item is not null and text is not null")
    items = item_templates(items.distinct().select("item", F.xxhash64("text").alias("variant"), "text"))
    windows = stage(item_windows(items, width, least_words), "windows")
    raw = rows.select("id", raw_tokens(F.col("text")).alias("raw"))
    keyed = with_windows(raw, width, F.transform("raw", lambda t: F.xxhash64(typed(t))))
    marked = keyed.withColumn("places", marked_places("keys", key_bits(windows, windows.count(), most_bits)))
    hits = F.transform("places", lambda p: F.struct(p.alias("place"), F.get("keys", p).alias("key"), F.slice("raw", p + 1, F.lit(width)).alias("doc_raw")))
    # Outer, since Spark else tests first whether the array is empty, and for that works it out anew.
    each = marked.select("id", F.explode_outer(hits).alias("hit")).select("id", "hit.*")
    pair = ["id", "item", "variant", "kind"]
    found = each.join(windows, "key").withColumn("shift", F.col("place") - F.col("at"))
    shifts = found.groupBy(*pair, "shift").agg(F.collect_set(F.struct("at", "place", "raw", "doc_raw")).alias("hits"), F.max("n").alias("n"))
    # Hits of one shift, and of shifts near each other (two overlapping rows of bands): words put in or left out move the rest.
    bands = F.array(F.struct(F.lit(0).alias("row"), F.col("shift").cast("long").alias("band")),
                    F.struct(F.lit(1).alias("row"), F.floor(F.col("shift") / slack).alias("band")),
                    F.struct(F.lit(2).alias("row"), F.floor((F.col("shift") + slack // 2) / slack).alias("band")))
    lines = shifts.withColumn("band", F.explode(bands)).groupBy(*pair, "band").agg(F.flatten(F.collect_list("hits")).alias("hits"), F.max("n").alias("n"))
    lines = lines.withColumn("ats", F.array_distinct(F.transform("hits", lambda h: h["at"]))).withColumn("coverage", F.size("ats") / F.col("n"))
    in_row = F.exists("ats", lambda x: F.forall(F.sequence(F.lit(1), F.lit(run - width)), lambda k: F.array_contains(F.col("ats"), x + k)))
    lines = lines.withColumn("covered", F.size(F.array_distinct(F.flatten(F.transform("ats", lambda x: F.sequence(x, x + width - 1))))))
    enough = (F.col("coverage") >= coverage) | (F.col("covered") >= run) & (F.col("covered") >= coverage * (F.col("n") + width - 1)) | in_row

    # Tokens met: the item's beside the document's, at the placeholders of matched windows.
    beside = lambda h: F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: F.struct(
        (h["at"] + k).alias("at"), F.get(h["raw"], k).alias("item"), F.get(h["doc_raw"], k).alias("doc")))
    is_slot = lambda t: t.startswith(_OPEN) | (t < ":")
    value = lambda t: F.regexp_replace(F.lower(F.regexp_replace(t, f"[{_OPEN}{_OPENER}{_CLOSE}]", "")), r"\s+", " ")
    met = F.filter(F.array_distinct(F.flatten(F.transform("hits", beside))), lambda x: is_slot(x["item"]))
    pairs = lines.where(enough).select(*pair, "coverage", met.alias("met"))
    opens = lambda t: t.startswith(_OPEN + _OPENER)
    checked = F.filter("met", lambda x: ~(opens(x["item"]) | opens(x["doc"])))
    pairs = pairs.withColumn("values", F.transform(checked, lambda x: F.struct(x["item"].startswith(_OPEN).alias("name"), value(x["item"]).alias("item"), value(x["doc"]).alias("doc"))))
    names = F.filter("values", lambda v: v["name"])
    different = lambda rows, field=None: F.size(F.array_distinct(F.transform(rows, lambda v: v[field]) if field else rows))
    one_to_one = (different(F.col("values")) == different(F.col("values"), "item")) & (different(names) == different(names, "doc"))
    alike = F.forall("met", lambda x: value(x["item"]) == value(x["doc"]))
    best = (pairs.select(*pair, "coverage", one_to_one.alias("right"), F.size(F.array_distinct(F.transform("met", lambda x: x["at"]))).cast("long").alias("slots"), alike.alias("exact"))
            .groupBy("id", "item", "variant").agg(
                F.max(F.when(F.col("right"), F.struct("coverage", "slots", "exact"))).alias("best"),
                F.bool_or(F.col("kind") == TYPED).alias("typed"), F.bool_or((F.col("kind") == TYPED) & F.col("right")).alias("right")))
    # Where names were placeholders and told another question, the words alone don't count.
    return (best.where(~F.col("typed") | F.col("right")).groupBy("id", "item").agg(F.max("best").alias("best"))
            .where("best is not null").select("id", "item", "best.*"))
