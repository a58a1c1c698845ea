"""Top-k search for a whole table of queries.

Scoring every (query, document) pair that shares a word is quadratic in a popular word. Exact
reductions keep the work near the size of the answer:

* Queries with the same tokens are searched once.
* Each word has an impact profile: how many postings it has per frequency band, with the smallest
  and largest frequency of the band. From it follow, per query and before any pair is formed, a
  lower bound on the k-th best score and upper bounds on what each word can contribute. A document
  that reaches the bound must reach its proportional share in at least one word, so only postings
  above that share become candidates. The join on (word, band) visits just those bands. What the
  candidates are known to score by then rules out most of them; the rest is scored in full. (This is
  the three-phase uniform-threshold scheme of Cao and Wang, 2004, with shares per word.)
* If all words of a query weigh less than nothing (they are in nearly all documents), the same holds
  mirrored: the best documents have the lowest frequencies, and only the lowest bands are visited.
* If all words weigh nothing (the snapshot does not know them), all documents score 0, and the smallest
  ids of each word are enough.

What is left, queries whose bound prunes too little by the profile, is scored from all its postings.
Every way returns the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.functions.scoring import mean_score
from lexspark.functions.text import tokens
from lexspark.operators.index import count_words
from lexspark.operators.search import DEFAULT_K, attach_text, check_k
from lexspark.session import broadcast_if_few, is_small, materialise

#: Bands per power of two, and the lowest band. A word has at most ``-LOWEST_BAND + 1`` bands.
BANDS_PER_OCTAVE = 2
LOWEST_BAND = -64
#: Slack for rounding to the score's decimals, and for the order of floating-point sums.
ROUNDING_SLACK = 1.1e-8
RELATIVE_SLACK = 1e-9
#: A query is pruned if this many visits of its candidate postings are cheaper than all its postings.
PRUNING_FACTOR = 2


def frequency_band(word_frequency: Column) -> Column:
    exponent = F.floor(F.log2(word_frequency.cast("double")) * BANDS_PER_OCTAVE)
    return F.greatest(F.coalesce(exponent, F.lit(LOWEST_BAND)), F.lit(LOWEST_BAND)).cast("int")


def impact_profile(postings: DataFrame) -> DataFrame:
    """``(word, band, n, tf_min, tf_max)``; every aggregate combines map-side."""
    tf = F.col("word_frequency").cast("double")
    return (
        postings.select("word", frequency_band(tf).alias("band"), tf.alias("_tf"))
        .groupBy("word", "band")
        .agg(F.count(F.lit(1)).alias("n"), F.min("_tf").alias("tf_min"), F.max("_tf").alias("tf_max"))
    )


def distinct_queries(queries: DataFrame, query_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``(query_id, rep)`` and ``(rep, words)``: one representative per distinct multiset of tokens."""
    listed = queries.select(query_col, F.sort_array(tokens(F.col(text_col))).alias("words")).filter(
        F.size("words") > 0
    )
    reps = listed.groupBy("words").agg(F.min(query_col).alias("rep"))
    members = listed.join(reps, "words").select(query_col, "rep")
    return members, reps.select("rep", "words")


def query_plan(weights: DataFrame, profile: DataFrame, k: int) -> DataFrame:
    """Per (rep, word): its weight, the useful frequencies (``tf_floor`` to ``tf_ceiling``) and the route.

    Windows run over the bands of one word (at most ``-LOWEST_BAND + 1`` rows) and over the words of
    one query text.
    """
    down = Window.partitionBy("word").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy("word").orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        profile.withColumn("_cum", F.sum("n").over(down))
        .withColumn("_low", F.min("tf_min").over(down))
        .withColumn("_cum_up", F.sum("n").over(up))
        .withColumn("_high", F.max("tf_max").over(up))
    )
    words = ranked.groupBy("word").agg(
        F.sum("n").alias("df"),
        F.max("tf_max").alias("tf_max"),
        F.max(F.when(F.col("_cum") >= k, F.col("_low"))).alias("tf_kth"),
        F.min(F.when(F.col("_cum_up") >= k, F.col("_high"))).alias("tf_kth_low"),
        F.collect_list(
            F.struct("band", "n", F.col("tf_max").alias("top"), F.col("tf_min").alias("bottom"))
        ).alias("bands"),
    )
    weighted = (
        weights.select("rep", "n_tokens", "word", "weight")
        .join(words, "word")
        .withColumn("_up", F.greatest(F.col("weight"), F.lit(0.0)) * F.col("tf_max"))
        .withColumn("_down", F.least(F.col("weight"), F.lit(0.0)) * F.col("tf_max"))
    )
    query = Window.partitionBy("rep")
    weight, negative = F.col("weight"), F.max("weight").over(query) < 0
    # k documents reach the best single-word k-th frequency; other words can only take away _down.
    best_word = F.max(F.when(weight > 0, weight * F.col("tf_kth"))).over(query)
    bound = best_word + F.sum("_down").over(query)
    slack = ROUNDING_SLACK * F.col("n_tokens") + RELATIVE_SLACK * F.col("_sum_up")
    floor = F.when(
        (weight > 0) & (F.col("_bound") > 0),
        F.col("_bound") / F.col("_sum_up") * F.col("tf_max") * (1 - RELATIVE_SLACK),
    ).when(F.col("_negative"), F.lit(0.0))
    # Mirrored: k documents lose no more in one word than its k-th lowest frequency takes.
    least_loss = F.max(weight * F.col("tf_kth_low") - F.col("_down")).over(query) + F.sum("_down").over(query)
    low_slack = ROUNDING_SLACK * F.col("n_tokens") - RELATIVE_SLACK * F.sum("_down").over(query)
    ceiling = F.when(F.col("_negative"), (least_loss - low_slack) / weight * (1 + RELATIVE_SLACK))
    in_reach = lambda b: (b.top >= F.col("tf_floor")) & (
        F.col("tf_ceiling").isNull() | (b.bottom <= F.col("tf_ceiling"))
    )
    useful = F.col("tf_floor").isNotNull() & (~F.col("_negative") | F.col("tf_ceiling").isNotNull())
    bounded = (
        weighted.withColumn("_sum_up", F.sum("_up").over(query))
        .withColumn("_bound", bound - slack)
        .withColumn("_negative", negative)
        .withColumn("tf_floor", floor)
        .withColumn("tf_ceiling", ceiling)
        .withColumn("reached", F.when(useful, F.filter("bands", in_reach)))
        .withColumn("_hits", F.aggregate("reached", F.lit(0).cast("bigint"), lambda hits, b: hits + b.n))
    )
    # Completing the few survivors costs little; finding candidates twice over must beat the direct way.
    cheap = PRUNING_FACTOR * F.sum("_hits").over(query) < F.sum("df").over(query)
    pruned = ((F.col("_bound") > 0) | F.col("_negative")) & cheap
    flat = (F.max("weight").over(query) == 0) & (F.min("weight").over(query) == 0)
    return bounded.withColumn("pruned", F.coalesce(pruned, F.lit(False))).select(
        "rep",
        "n_tokens",
        "word",
        "weight",
        "tf_floor",
        "tf_ceiling",
        "pruned",
        flat.alias("flat"),
        F.when(F.col("_negative"), F.lit(0.0)).otherwise(F.col("_bound")).alias("bound"),
        F.sum("_down").over(query).alias("down"),
        F.transform("reached", lambda b: b.band).alias("bands"),
    )


def term_weights(reps: DataFrame, idf: DataFrame, dedupe_query_terms: bool) -> DataFrame:
    """``(rep, n_tokens, word, weight)``; words without an IDF weigh 0."""
    repeats = F.lit(1) if dedupe_query_terms else F.col("word_count")
    return (
        count_words(reps, F.col("words"), ["rep"])
        .join(idf.select("word", "idf"), "word", "left")
        .select(
            "rep",
            F.col("total_words").alias("n_tokens"),
            "word",
            (repeats * F.coalesce("idf", F.lit(0.0))).alias("weight"),
        )
    )


def direct_parts(postings: DataFrame, weights: DataFrame) -> DataFrame:
    """``(rep, n_tokens, id, part)``: the share of every matching posting in its document's score."""
    return postings.join(broadcast_if_few(weights), "word")


def probed(postings: DataFrame, probes: DataFrame, blocks: DataFrame | None, id_col: str) -> DataFrame:
    """``probes`` with the postings (id, tf) of their words that lie in reach of their bounds.

    Of ``blocks`` only those are opened whose frequencies are in reach.
    """
    ceiling = F.col("tf_ceiling")
    if blocks is None:
        each = probes.withColumn("band", F.explode("bands")).drop("bands")
        found = postings.withColumn("band", frequency_band(F.col("tf"))).join(broadcast_if_few(each), ["word", "band"])
    else:
        wanted = (F.col("tf_max") >= F.col("tf_floor")) & (ceiling.isNull() | (F.col("tf_min") <= ceiling))
        opened = blocks.join(broadcast_if_few(probes.drop("bands")), "word").filter(wanted)
        found = opened.withColumn("_p", F.explode("postings")).drop("postings")
        found = found.withColumns({id_col: F.col(f"_p.{id_col}"), "tf": F.col("_p.word_frequency").cast("double")})
    return found.filter(F.col("tf") >= F.col("tf_floor")).filter(ceiling.isNull() | (F.col("tf") <= ceiling))


def candidates(postings: DataFrame, plan: DataFrame, k: int, id_col: str, blocks: DataFrame | None = None) -> DataFrame:
    """``(rep, id)`` that can still be among the best ``k`` of the pruned queries of a plan.

    A document seen in some words scores at least what those words give, and at most that plus the
    floors of the words in which it was not seen. The k-th best lower bound rules out the rest.
    """
    probes = plan.filter("pruned").select(
        "rep", "n_tokens", "word", "weight", "tf_floor", "tf_ceiling", "bound", "down", "bands"
    )
    seen = (
        probed(postings, probes, blocks, id_col)
        .groupBy("rep", "n_tokens", "bound", "down", id_col)
        .agg(
            F.sum(F.col("weight") * F.col("tf")).alias("_known"),
            F.sum(F.col("weight") * F.col("tf_floor")).alias("_floors"),
        )
        .select(
            "rep",
            id_col,
            (F.col("_known") + F.col("down")).alias("_least"),
            (F.col("_known") + F.col("bound") - F.col("_floors")).alias("_most"),
            (ROUNDING_SLACK * F.col("n_tokens") + RELATIVE_SLACK * F.col("_known")).alias("_slack"),
        )
    )
    seen = materialise(seen, "query-candidates")
    best = Window.partitionBy("rep").orderBy(F.desc("_least"))
    leaders = seen.select("rep", "_least").withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= k)
    needed = leaders.groupBy("rep").agg(F.min("_least").alias("_needed"), F.max("_place").alias("_leaders"))
    enough = (F.col("_leaders") < k) | (F.col("_most") + F.col("_slack") >= F.col("_needed"))
    return seen.join(needed, "rep").filter(enough).select("rep", id_col)


def smallest_ids(postings: DataFrame, plan: DataFrame, k: int, id_col: str) -> DataFrame:
    """``(rep, id)`` for the queries whose words all weigh nothing: the ``k`` smallest ids per word.

    The rank is limited before the shuffle, so a word in all documents sends ``k`` rows per task.
    """
    asked = plan.filter("flat").select("rep", "word")
    by_id = Window.partitionBy("word").orderBy(id_col)
    held = postings.select("word", id_col).join(broadcast_if_few(asked.select("word").distinct()), "word", "left_semi")
    first = held.withColumn("_place", F.row_number().over(by_id)).filter(F.col("_place") <= k)
    return first.join(asked, "word").select("rep", id_col).distinct()


def completed(postings: DataFrame, plan: DataFrame, found: list[DataFrame], id_col: str) -> DataFrame:
    """The parts of the candidates ``found`` only, looked up for all words of their query.

    The candidates are joined by id and the words of their queries after that, so neither side holds a row per
    candidate and word, unless there are too many queries to broadcast their words.
    """
    weights = plan.filter("pruned OR flat").select("rep", "n_tokens", "word", "weight")
    pairs = materialise(reduce(DataFrame.union, found), "query-pairs")
    if is_small(weights):
        return postings.join(broadcast_if_few(pairs), id_col).join(F.broadcast(weights), ["rep", "word"])
    lookups = materialise(pairs.join(weights.hint("merge"), "rep"), "query-lookups")
    return postings.join(broadcast_if_few(lookups), [id_col, "word"])


def batch_search(
    queries: DataFrame,
    postings: DataFrame,
    idf: DataFrame,
    documents: DataFrame | None = None,
    k: int = DEFAULT_K,
    dedupe_query_terms: bool = False,
    strategy: str = "bounded",
    profile: DataFrame | None = None,
    blocks: DataFrame | None = None,
    query_col: str = "query_id",
    query_text_col: str = "text",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(query_id, rank, id, score[, text])``: the rows that one ``search`` per query would give.

    ``strategy`` is ``"bounded"`` (candidates by impact bounds) or ``"direct"`` (score every matching
    posting, for batches known to be small). Both give the same rows.

    ``postings`` is read several times and should be a stored table; ``query_col`` must be unique.
    An ``impact_profile`` stored with the index saves the pass that computes it for the words of the queries, and
    ``posting_blocks`` let candidates be found without opening what is out of reach. What a batch does not need
    (candidates, smallest ids, all postings of some queries) is not read for it.
    """
    check_k(k)
    if strategy not in ("direct", "bounded"):
        raise ValueError(f"unknown strategy {strategy!r}")
    members, reps = distinct_queries(queries, query_col, query_text_col)
    weights = materialise(term_weights(reps, idf, dedupe_query_terms), "query-weights")
    vocabulary = broadcast_if_few(weights.select("word").distinct())
    posted = postings.select(id_col, "word", F.col("word_frequency").cast("double").alias("tf"))
    relevant = posted.join(vocabulary, "word", "left_semi")
    columns = ["rep", "n_tokens", id_col, (F.col("tf") * F.col("weight")).alias("part")]
    if strategy == "direct":
        parts = direct_parts(posted, weights).select(*columns)
    else:
        if profile is None:
            profile = impact_profile(relevant.withColumnRenamed("tf", "word_frequency"))
        else:
            profile = profile.join(vocabulary, "word", "left_semi")
        plan = materialise(query_plan(weights, profile, max(k, 1)), "query-plan")
        rest = plan.filter("NOT pruned AND NOT flat").select("rep", "n_tokens", "word", "weight")
        kinds = {(r["pruned"], r["flat"]) for r in plan.select("pruned", "flat").distinct().collect()}  # four at most
        ways = []
        if any(not pruned and not flat for pruned, flat in kinds) or not kinds:
            ways.append(direct_parts(posted, rest).select(*columns))
        found = []
        if any(pruned for pruned, _ in kinds):
            found.append(candidates(relevant, plan, max(k, 1), id_col, blocks))
        if any(flat for _, flat in kinds):
            found.append(smallest_ids(relevant, plan, max(k, 1), id_col))
        if found:
            ways.append(completed(relevant, plan, found, id_col).select(*columns))
        parts = reduce(DataFrame.unionByName, ways)

    scored = (
        parts.groupBy("rep", "n_tokens", id_col)
        .agg(F.sum("part").alias("_sum"))
        .select("rep", id_col, mean_score(F.col("_sum"), F.col("n_tokens")).alias("score"))
    )
    best = Window.partitionBy("rep").orderBy(F.desc("score"), F.col(id_col))
    top = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    results = members.join(top, "rep").select(query_col, "rank", id_col, "score")
    if documents is None:
        return results
    return attach_text(materialise(results, "query-results"), documents, id_col, text_col)
