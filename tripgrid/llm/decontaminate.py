"""Benchmark decontamination: which documents contain windows of benchmark items.

A prefix-filtered set join. A window of an item is a set of word shingles at fixed places; it occurs
in a document only if all of them do, so under containment 1 the prefix that must be shared is one
token: the window's rarest word. Words are ordered by how often they occur in all documents.

1. Count the benchmark's words in the documents (one aggregation, combined before its shuffle).
2. Index every distinct window under its rarest word, with the word's place in the window.
3. In each document keep the places of such words, each with the words around it, at most a window
   to either side; join them with the index on the word.
4. Length and positional bounds drop places where the window would leave the document; what remains
   is compared word by word.

Documents never leave their task whole: only thin rows (places and results) are shuffled.

Null and empty texts have no words. Items without words have no window; items without an id count
under the empty string, items with the same id as one. Repeated documents each get their own row. An
empty table of documents gives an empty one, and without items nothing is hit. Other columns are not
looked at, and kept by ``decontaminated`` whatever their names.
"""

from pyspark.sql import Window, functions as F

from .common import ROW, Staging, bounded, matching, words

WINDOW = 13


def item_windows(benchmark, window=WINDOW):
    """Windows and the items that hold them, each pair once: ``window_id, words, item``.

    ``window`` consecutive words; an item of fewer words, but not none, is one window.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("_words")
    ).filter(F.size("_words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_words") - window + 1, F.lit(1)))
    cut = items.select("item", F.explode(F.transform(starts, lambda i: F.slice("_words", i, window))).alias("words"))
    return cut.distinct().withColumn("window_id", F.sha2(F.concat_ws(" ", "words"), 256))


def _word_counts(documents, vocabulary):
    """How often each word of the vocabulary occurs in the documents."""
    spoken = documents.select(F.explode(words(F.col("text"))).alias("word"))
    counted = spoken.join(bounded(vocabulary), "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return vocabulary.join(counted, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))


def prefix_index(windows, counts):
    """Windows under the word they must share: ``word, before, words, window_id``.

    The word is the window's rarest (then smallest); ``before`` is how many words precede it.
    """
    placed = windows.select("window_id", "words", F.posexplode("words").alias("before", "word")).join(bounded(counts), "word")
    rarest = Window.partitionBy("window_id").orderBy("n", "word", "before")
    return (
        placed.withColumn("_order", F.row_number().over(rarest)).filter("_order = 1")
        .select("word", "before", "words", "window_id")
    )


def occurrences(documents, index, prefixes, window=WINDOW):
    """One row per document and occurrence of a window, at least one per document.

    Columns ``_row, doc_id, text_hash, n_words, start, length, window_id``; the last three are null where
    nothing occurs. ``prefixes`` are the index's words as a Python set, or None to join all words.
    """
    split = documents.select(
        F.monotonically_increasing_id().alias(ROW), "doc_id", F.xxhash64("text").alias("text_hash"),
        words(F.col("text")).alias("_words"),
    )
    around = window - 1

    def place(word, i):
        first = F.greatest(i - around, F.lit(0))
        return F.struct(
            word.alias("word"), i.alias("at"), (i - first).alias("left"),
            F.slice("_words", first + 1, i - first + around + 1).alias("near"),
        )

    marked = F.transform("_words", lambda word, i: F.when(word.isin(prefixes), i)) if prefixes is not None else (
        F.transform("_words", lambda word, i: i))
    places = F.transform(
        F.array_compact(marked), lambda i: place(F.get("_words", i), i)
    )
    found = split.select(
        ROW, "doc_id", "text_hash", F.size("_words").cast("long").alias("n_words"), F.explode_outer(places).alias("p")
    ).select(ROW, "doc_id", "text_hash", "n_words", "p.*")
    inside = (F.col("at") >= F.col("before")) & (F.col("at") - F.col("before") + F.size("words") <= F.col("n_words"))
    same = F.slice("near", F.col("left") - F.col("before") + 1, F.size("words")) == F.col("words")
    index = index.withColumnRenamed("word", "_prefix")
    matched = found.join(bounded(index), (F.col("word") == F.col("_prefix")) & inside & same, "left")
    hit = F.col("window_id").isNotNull()
    return matched.select(
        ROW, "doc_id", "text_hash", "n_words", F.when(hit, F.col("at") - F.col("before")).alias("start"),
        F.when(hit, F.size("words")).alias("length"), "window_id",
    )


# Up to so many prefix words are looked up in each document's array, which then yields only their
# places; with more of them every word is a place, and the join alone decides. Results are the same.
LOOKED_UP = 100_000


def contamination(documents, benchmark, window=WINDOW, one_in=20, staging=None):
    """One row per document: ``doc_id, n_words, n_hit, n_items, items, contaminated, text_hash``.

    A word within any occurrence of a window is hit; ``items`` are the ids of the items with such
    windows, sorted. Contaminated: at least one word and at least one in ``one_in`` words are hit.
    ``text_hash`` tells documents apart that share an id.
    """
    staging = staging or Staging(documents.sparkSession)
    owned = staging.table(item_windows(benchmark, window), "owned")
    windows = staging.table(owned.select("window_id", "words").distinct(), "windows")
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    counts = staging.table(_word_counts(documents, staging.table(vocabulary, "vocabulary")), "counts")
    index = staging.table(prefix_index(windows, counts), "index")
    prefixes = index.select("word").distinct()
    known = [r.word for r in prefixes.limit(LOOKED_UP + 1).collect()]
    found = occurrences(documents, index, known if len(known) <= LOOKED_UP else None, window)
    owners = owned.select("window_id", "item")
    per_document = found.groupBy(ROW, "doc_id", "text_hash", "n_words").agg(
        F.sort_array(F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "length")))).alias("_runs"),
        F.collect_set("window_id").alias("_windows"),
    )
    covered = F.aggregate(
        "_runs", F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end")),
        lambda a, r: F.struct(
            (a["hit"] + F.greatest(r["start"] + r["length"] - F.greatest(a["end"], r["start"]), F.lit(0))).alias("hit"),
            F.greatest(a["end"], r["start"] + r["length"]).alias("end"),
        ),
        lambda a: a["hit"].cast("long"),
    )
    hits = staging.table(per_document.withColumn("n_hit", covered).drop("_runs"), "hits")
    named = (
        hits.select(ROW, F.explode("_windows").alias("window_id")).join(bounded(owners), "window_id")
        .groupBy(ROW).agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    items = F.coalesce("items", F.array().cast("array<string>"))
    return hits.drop("_windows").join(named, ROW, "left").select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"), items.alias("items"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words"))).alias("contaminated"), "text_hash",
    )


def decontaminated(documents, benchmark, window=WINDOW, one_in=20, staging=None):
    """The documents that are not contaminated, with all their columns."""
    judged = contamination(documents, benchmark, window, one_in, staging).filter("contaminated")
    return matching(documents, judged, "left_anti")
