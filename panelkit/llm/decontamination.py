"""Benchmark decontamination with a distributed positional inverted index.

Words are what is left of a text, in lower case, between ASCII characters
other than letters and digits.  The benchmark's items are cut into windows of
``window`` consecutive words (a shorter item is one window).  A window *occurs*
where a document has its words in its order.

Occurrences come from posting lists ``term, row, pos`` of the documents.  The
terms of each window are counted in the whole corpus and sorted from the
rarest.  A posting of the rarest term, less the term's offset in the window,
is a start at which the window may occur; the starts are then intersected with
the offset-adjusted postings of the next rarest terms.  With ``slop`` the
lists may differ by so many places, which gives the proximity matches; exact
phrases (slop 0) are confirmed on the words themselves, so that the 64-bit
hashes that stand for terms never decide.

Only terms that some window needs are posted.  The tables that go to every
task (terms and window plans: fixed-size rows) hold one slab of at most
``slab`` windows; a larger benchmark is matched slab by slab.  All joins of
postings are on (row, term, position), so neither a frequent word nor a
document is a hot key.  Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.llm.common import lower_ascii
from panelkit.session import materialize

_BREAKS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def plain_words(text: Column) -> Column:
    """Lower-case words of a text (null: none)."""
    spaced = F.translate(lower_ascii(text), _BREAKS, " " * len(_BREAKS))
    return F.coalesce(F.filter(F.split(spaced, " "), lambda w: w != ""), F.array().cast("array<string>"))


def _term(word: Column) -> Column:
    return F.xxhash64(word)


def tokenized(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``row, doc_id, n_words, words``, written once; ``row`` numbers the input rows."""
    words = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"),
                        plain_words(F.col(text)).alias("words"))
    return materialize(words.withColumn("n_words", F.size("words").cast("long")), "words")


def windows_of(items: DataFrame, key: str, text: str, window: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (``win, words``) and the items that hold them (``win, item_id``)."""
    words = items.select(F.col(key).alias("item_id"), plain_words(F.col(text)).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    held = words.withColumn("_s", F.explode(starts)).select("item_id", F.slice("words", F.col("_s"), window).alias("words"))
    held = materialize(held.distinct(), "held")
    wins = materialize(held.select("words").distinct().withColumn("win", F.monotonically_increasing_id()), "windows")
    pairs = held.filter(F.col("item_id").isNotNull()).join(wins, "words").select("win", "item_id")
    return wins, materialize(pairs, "window_items")


def _slabs(wins: DataFrame, slab: int):
    """Parts of at most about ``slab`` windows."""
    n = wins.count()
    parts = -(-n // slab)
    for i in range(parts):
        yield wins if parts == 1 else wins.filter(F.pmod(F.xxhash64("win"), F.lit(parts)) == i)


def rarest_terms(tokens: DataFrame, wins: DataFrame, rare: int) -> DataFrame:
    """``win, terms``: structs ``n, off, term`` of ``rare`` distinct terms of each
    window, the rarest in the corpus first (of fewer, the last is repeated);
    windows with a term that the corpus lacks are left out."""
    places = wins.select("win", F.posexplode("words").alias("off", "word")).select(
        "win", "off", _term(F.col("word")).alias("term"))
    wanted = places.select("term").distinct()
    words = tokens.select(F.explode("words").alias("word")).select(_term(F.col("word")).alias("term"))
    counts = words.join(F.broadcast(wanted), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    firsts = places.groupBy("win", "term").agg(F.min("off").alias("off"))
    ranked = (firsts.join(counts, "term", "left")
              .groupBy("win").agg(F.sort_array(F.collect_list(F.struct(
                  F.coalesce("n", F.lit(0)).alias("n"), "off", "term"))).alias("terms")))
    last = F.size("terms") - 1
    firsts = F.array(*[F.get("terms", F.least(F.lit(k), last)) for k in range(rare)])
    return materialize(ranked.filter(F.col("terms")[0]["n"] > 0).select("win", firsts.alias("terms")), "rarest")


def postings(tokens: DataFrame, plan: DataFrame) -> DataFrame:
    """The index: ``term, row, pos`` of every term that the plan of a window names."""
    wanted = plan.select(F.explode("terms").alias("t")).select("t.term").distinct()
    spots = tokens.select("row", F.posexplode("words").alias("pos", "word")).select(
        _term(F.col("word")).alias("term"), "row", "pos")
    return materialize(spots.join(F.broadcast(wanted), "term", "left_semi"), "postings")


def intersected(index: DataFrame, plan: DataFrame, rare: int, slop: int = 0) -> DataFrame:
    """``row, start, win``: places where the rarest terms of a window stand
    within ``slop`` of their offsets from ``start`` (counted from the rarest)."""
    first = F.broadcast(plan.withColumn("term", F.col("terms")[0]["term"]))
    found = index.join(first, "term").select(
        "row", (F.col("pos") - F.col("terms")[0]["off"]).alias("start"), "win", "terms")
    if not slop:
        found = found.filter(F.col("start") >= 0)
    width = 2 * slop + 1
    lists = index.select(F.col("term").alias("_t"), F.col("row").alias("_r"), F.col("pos").alias("_p"),
                         F.floor(F.col("pos") / width).alias("_b"))
    for k in range(1, rare):
        step = F.col("terms")[k]
        more = found.withColumn("_term", step["term"]).withColumn("_need", F.col("start") + step["off"])
        same = (F.col("_term") == F.col("_t")) & (F.col("row") == F.col("_r"))
        if slop:
            more = more.withColumn("_bucket", F.explode(F.sequence(
                F.floor((F.col("_need") - slop) / width), F.floor((F.col("_need") + slop) / width))))
            near = same & (F.col("_bucket") == F.col("_b")) & F.col("_p").between(
                F.col("_need") - slop, F.col("_need") + slop)
            met = more.join(lists, near, "left_semi").drop("_bucket").dropDuplicates(["row", "start", "win"])
        else:
            met = more.join(lists, same & (F.col("_need") == F.col("_p")), "left_semi")
        found = met.select(*found.columns)
    return found.select("row", "start", "win")


def confirmed(tokens: DataFrame, wins: DataFrame, found: DataFrame, rows_bound: int = 1 << 20) -> DataFrame:
    """``row, start, stop, win`` of the places that hold exactly the words of their window."""
    found = materialize(found, "found")
    rows = found.select(F.col("row").alias("_r")).distinct()
    if found.count() <= rows_bound:  # else the rows meet by a shuffle
        rows = F.broadcast(rows)
    texts = tokens.select("row", "words").join(rows, F.col("row") == F.col("_r"), "left_semi")
    asked = found.join(wins.withColumnRenamed("words", "asked"), "win").withColumnRenamed("row", "_row")
    return (asked.join(texts, F.col("_row") == F.col("row"))
            .filter(F.slice("words", F.col("start") + 1, F.size("asked")) == F.col("asked"))
            .select("row", "start", (F.col("start") + F.size("asked")).alias("stop"), "win"))


def matches(tokens: DataFrame, wins: DataFrame, rare: int = 3, near: int = 0,
            slab: int = 1 << 18) -> tuple[DataFrame, DataFrame | None]:
    """Exact phrase matches ``row, start, stop, win`` and, with ``near``, the
    proximity matches ``row, start, win``."""
    spark = tokens.sparkSession
    exact = spark.createDataFrame([], "row long, start int, stop int, win long")
    close = spark.createDataFrame([], "row long, start int, win long") if near else None
    for part in _slabs(wins, slab):
        plan = rarest_terms(tokens, part, rare)
        index = postings(tokens, plan)
        exact = exact.unionByName(confirmed(tokens, part, intersected(index, plan, rare)))
        if near:
            close = close.unionByName(intersected(index, plan, rare, near))
    return materialize(exact, "phrases"), close


def _named(found: DataFrame, pairs: DataFrame, bound: int = 1 << 20, salts: int = 64) -> DataFrame:
    """``row, item_id`` of the windows found in each row.  A window that many
    rows hold is no hot key: the item table goes to every task or is salted."""
    held = found.select("row", "win").distinct()
    if pairs.count() <= bound:
        return held.join(F.broadcast(pairs), "win").select("row", "item_id").distinct()
    pairs = pairs.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (held.withColumn("_s", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
            .join(pairs, ["win", "_s"]).select("row", "item_id").distinct())


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = 10, rare: int = 3,
                  near: int = 0) -> DataFrame:
    """Words of every document inside benchmark windows.

    Returns one row per input row: ``doc_id, n_words, n_hit`` (words inside an
    occurrence of a window), ``items`` (names of the items with an occurring
    window, sorted as strings), ``spans`` (structs ``start, stop``: the hit
    words, overlapping occurrences merged) and ``n_near`` (items that have a
    proximity match; 0 without ``near``).  A null text has no words, an item
    without words no window; a repeated item is one item, an item with a null
    key is matched but has no name; keys of documents may be null or repeated;
    a very long text is matched whole; other columns are ignored; an empty
    table gives an empty result, an empty benchmark no hits.
    """
    tokens = tokenized(docs, key, text)
    wins, pairs = windows_of(benchmark, item, item_text, window)
    exact, close = matches(tokens, wins, rare, near)
    along = Window.partitionBy("row").orderBy("start", "stop")  # occurrences inside one document
    reach = F.max("stop").over(along.rowsBetween(Window.unboundedPreceding, -1))
    runs = (exact.select("row", "start", "stop").distinct()
            .withColumn("_new", (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int"))
            .withColumn("_run", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("row", "_run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")))
    hits = runs.groupBy(F.col("row").alias("_row")).agg(
        F.sum(F.col("stop") - F.col("start")).alias("n_hit"),
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    names = _named(exact, pairs).groupBy(F.col("row").alias("_row")).agg(
        F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    out = hits.join(names, "_row", "left")
    if near:
        loose = _named(close, pairs).groupBy(F.col("row").alias("_row")).agg(F.count(F.lit(1)).alias("n_near"))
        out = out.join(loose, "_row", "full")
    else:
        out = out.withColumn("n_near", F.lit(0).cast("long"))
    return (tokens.select("row", "doc_id", "n_words").join(out, F.col("row") == F.col("_row"), "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans"),
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")))
