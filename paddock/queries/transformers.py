"""Feature transformers and statistics of Spark ML on the given tables."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.feature import (
    PCA, BucketedRandomProjectionLSH, HashingTF, IDF, Imputer, MaxAbsScaler, MinHashLSH, NGram,
    RegexTokenizer, RobustScaler, StopWordsRemover, VectorAssembler,
)
from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import ChiSquareTest, Summarizer
from pyspark.sql import functions as F

from paddock.operators.hot import null_safe_join
from paddock.operators.parts import sent_if_few
from paddock.queries.registry import query
from paddock.session import checkpoint, written

# Rounds after which a fit that still moves is an error.
ROUNDS = 500
# Neighbours are asked for every so many rows, up to these distances.
ASKED_EVERY, VECTOR_DISTANCE, SET_DISTANCE = 50, 1.1, 0.3
# Two sets meet where all min hashes of a band agree.
BANDS, BAND_ROWS, SALTS = 16, 4, 8
STOP_WORDS = ["the", "and", "of", "und", "que"]
_TOKENS = """
    w AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '\\s'), lambda x: x <> '') AS ws FROM documents)"""


def _tokenizer(column):
    return RegexTokenizer(inputCol="text", outputCol=column, pattern=r"\s")


def _vectors(t):
    return t.embeddings.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


@query("m23_word_pairs", f"""
    WITH {_TOKENS}, k AS (SELECT doc_id, list_filter(ws, lambda x: x NOT IN ('the', 'and', 'of', 'und', 'que')) AS ws FROM w),
    p AS (SELECT ws[i] || ' ' || ws[i + 1] AS pair FROM k, LATERAL (SELECT unnest(range(1, len(ws))) AS i))
    SELECT pair, count(*) AS n FROM p GROUP BY 1 HAVING count(*) >= 5""")
def _(t):
    """Pairs of neighbouring words without stop words, found five times or more."""
    stages = [_tokenizer("words"), StopWordsRemover(inputCol="words", outputCol="kept", stopWords=STOP_WORDS, caseSensitive=True),
              NGram(n=2, inputCol="kept", outputCol="pairs")]
    paired = Pipeline(stages=stages).fit(t.documents).transform(t.documents)
    return paired.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")).where("n >= 5")


@query("m23_term_weights")
def _(t):
    """Hashed term frequencies weighted by inverse document frequency; the norm per document."""
    stages = [_tokenizer("words"), HashingTF(inputCol="words", outputCol="tf", numFeatures=4096), IDF(inputCol="tf", outputCol="features")]
    weighted = Pipeline(stages=stages).fit(t.documents).transform(t.documents)
    squares = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda s, x: s + x * x)
    return weighted.select("doc_id", F.round(F.sqrt(squares), 4).alias("norm"))


@query("m23_count_vectors", f"""
    WITH {_TOKENS}, d AS (SELECT DISTINCT doc_id, unnest(ws) AS word FROM w), f AS (SELECT word FROM d GROUP BY 1 HAVING count(*) >= 5)
    SELECT w.doc_id, count(f.word) AS n_terms FROM w LEFT JOIN d ON d.doc_id = w.doc_id LEFT JOIN f ON f.word = d.word GROUP BY 1""")
def _(t):
    """Distinct terms per document out of the terms found in five documents or more.

    The vocabulary stays a frame, so it may have any size.
    """
    split = _tokenizer("words").transform(t.documents)
    # The terms of a document are told apart in its row; only ids that come more than once need a shuffle for it.
    repeated = t.documents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    repeated, again = sent_if_few(written(repeated))
    terms = split.select("doc_id", F.explode(F.array_distinct("words")).alias("word"))
    if again:
        terms = null_safe_join(terms, repeated, ["doc_id"], "left_anti").unionByName(
            null_safe_join(terms, repeated, ["doc_id"], "left_semi").distinct())
    frequent = terms.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n >= 5").select("word")
    frequent, _ = sent_if_few(written(frequent))
    counted = terms.join(frequent, "word").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"))
    return t.documents.select("doc_id").join(counted, "doc_id", "left").select(
        "doc_id", F.coalesce("n_terms", F.lit(0)).cast("long").alias("n_terms"))


@query("m23_principal_components")
def _(t):
    vectors = _vectors(t)
    reduced = PCA(k=3, inputCol="features", outputCol="reduced").fit(vectors).transform(vectors)
    # The sign of a component is arbitrary.
    return reduced.select("vec_id", F.transform(vector_to_array("reduced"), lambda x: F.round(F.abs(x), 4)).alias("reduced"))


@query("m23_gaussian_mixture")
def _(t):
    vectors = _vectors(t)
    small = PCA(k=3, inputCol="features", outputCol="reduced").fit(vectors).transform(vectors)
    model = GaussianMixture(k=3, seed=14, featuresCol="reduced", maxIter=ROUNDS).fit(small)
    if model.summary.numIter >= ROUNDS:
        raise RuntimeError(f"the mixture still moves after {ROUNDS} rounds")
    return model.transform(small).groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


@query("m23_mean_imputer", """
    WITH g AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price FROM orders)
    SELECT o_orderkey, round(coalesce(price, (SELECT avg(price) FROM g)), 4) AS price FROM g""")
def _(t):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("price"))
    filled = Imputer(inputCols=["price"], outputCols=["filled"], strategy="mean").fit(rows).transform(rows)
    return filled.select("o_orderkey", F.round("filled", 4).alias("price"))


@query("m23_max_abs_scale", """
    SELECT c_custkey, round(c_acctbal / m, 6) AS balance FROM customer, (SELECT max(abs(c_acctbal)) AS m FROM customer)""")
def _(t):
    stages = [VectorAssembler(inputCols=["c_acctbal"], outputCol="v"), MaxAbsScaler(inputCol="v", outputCol="s")]
    scaled = Pipeline(stages=stages).fit(t.customer).transform(t.customer)
    return scaled.select("c_custkey", F.round(vector_to_array("s")[0], 6).alias("balance"))


@query("m23_robust_scale")
def _(t):
    stages = [VectorAssembler(inputCols=["c_acctbal"], outputCol="v"), RobustScaler(inputCol="v", outputCol="s", withCentering=True)]
    scaled = Pipeline(stages=stages).fit(t.customer).transform(t.customer)
    return scaled.select("c_custkey", F.round(vector_to_array("s")[0], 4).alias("balance"))


@query("m23_frequent_sets", """
    WITH RECURSIVE b AS (SELECT DISTINCT l_orderkey AS k, p_brand AS x FROM lineitem JOIN part ON l_partkey = p_partkey),
    n AS (SELECT ceil(0.015 * count(DISTINCT k)) AS least FROM b),
    s AS (SELECT k, x AS items, x AS last FROM b
          UNION ALL SELECT s.k, s.items || ' ' || b.x, b.x FROM s JOIN b ON b.k = s.k AND b.x > s.last)
    SELECT items, count(*) AS freq FROM s GROUP BY 1 HAVING count(*) >= (SELECT least FROM n)""")
def _(t):
    """Sets of brands of any size bought together; a basket has at most the 25 brands."""
    brands = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    baskets = brands.groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("items"))
    found = FPGrowth(itemsCol="items", minSupport=0.015).fit(baskets).freqItemsets
    return found.select(F.array_join(F.array_sort("items"), " ").alias("items"), "freq")


@query("m23_frequent_sequences")
def _(t):
    """Sequences of the yearly most frequent priority of a customer; as long as there are years."""
    counts = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("y"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    yearly = counts.groupBy("o_custkey", "y").agg(F.max_by("o_orderpriority", F.struct("n", "o_orderpriority")).alias("p"))
    listed = yearly.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("y", "p"))).alias("s"))
    sequences = listed.select(F.transform("s", lambda e: F.array(e["p"])).alias("sequence"))
    years = yearly.agg(F.countDistinct("y")).first()[0]
    found = PrefixSpan(minSupport=0.3, maxPatternLength=max(years, 1)).findFrequentSequentialPatterns(sequences)
    return found.select(F.to_json("sequence").alias("sequence"), "freq")


@query("m23_chi_square", """
    WITH o AS (SELECT o_orderstatus AS a, o_orderpriority AS b, count(*) AS n FROM orders GROUP BY 1, 2),
    e AS (SELECT n, sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS x FROM o)
    SELECT round(sum((n - x) * (n - x) / x), 6) AS statistic, 8 AS degrees FROM e""")
def _(t):
    """Independence of order status and priority."""
    status = F.array_position(F.array(F.lit("F"), F.lit("O"), F.lit("P")), F.col("o_orderstatus")).cast("double")
    label = F.substring("o_orderpriority", 1, 1).cast("double")
    rows = VectorAssembler(inputCols=["status"], outputCol="features").transform(t.orders.select(status.alias("status"), label.alias("label")))
    test = ChiSquareTest.test(rows, "features", "label", flatten=True)
    return test.select(F.round("statistic", 6).alias("statistic"), F.col("degreesOfFreedom").cast("int").alias("degrees"))


@query("m23_summarizer", """
    SELECT round(avg(l_quantity), 5) AS mean_quantity, round(var_samp(l_quantity), 5) AS var_quantity, round(var_samp(l_discount), 8) AS var_discount FROM lineitem""")
def _(t):
    rows = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="v").transform(t.lineitem)
    s = rows.select(Summarizer.metrics("mean", "variance").summary(F.col("v")).alias("s"))
    s = s.select(vector_to_array("s.mean").alias("m"), vector_to_array("s.variance").alias("v"))
    return s.select(F.round(F.col("m")[0], 5).alias("mean_quantity"), F.round(F.col("v")[0], 5).alias("var_quantity"),
                    F.round(F.col("v")[1], 8).alias("var_discount"))


@query("m23_projection_neighbours")
def _(t):
    """The vectors near to every 50th one, by random projections.

    Distances are exact; a pair at the bound is met with a chance of 0.98. The
    given vectors are all about as far from each other, so most pairs with a
    query vector meet in some bucket and the work grows with their number.
    """
    vectors = _vectors(t).where(F.col("features").isNotNull())
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=2.0, numHashTables=5, seed=14).fit(vectors)
    asked = vectors.where(F.pmod("vec_id", F.lit(ASKED_EVERY)) == 0)
    near = model.approxSimilarityJoin(asked, vectors, VECTOR_DISTANCE, "distance")
    return near.select(F.col("datasetA.vec_id").alias("query_id"), F.col("datasetB.vec_id").alias("vec_id"), F.round("distance", 4).alias("distance")).where(
        ~F.col("query_id").eqNullSafe(F.col("vec_id")))


@query("m23_set_neighbours")
def _(t):
    """The documents whose word set is near to that of every 50th document, by bands of min hashes.

    Distances are exact, over the words themselves; a pair at the bound is met
    with a chance of 0.98. Texts without words have no neighbours, repeated rows
    count once.
    """
    return near_sets(t.documents)


def near_sets(documents, distance=SET_DISTANCE):
    """(query_id, doc_id, distance) of the near sets.

    The rows of a bucket are dealt over ``SALTS`` parts, to which the few asked
    rows are copied, so a bucket of many copies is not one task.
    """
    key = F.xxhash64("doc_id", "text").alias("key")
    worded = _tokenizer("words").transform(documents.where("text IS NOT NULL").select("doc_id", "text", key)).where(F.size("words") > 0)
    sets = checkpoint(worded.select("key", "doc_id", F.array_distinct("words").alias("words")).dropDuplicates(["key"]))
    hashed = HashingTF(inputCol="words", outputCol="features", binary=True, numFeatures=1 << 18).transform(sets)
    model = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=BANDS * BAND_ROWS, seed=14).fit(hashed)
    # One vector of one value per hash.
    values = [vector_to_array(F.col("hashes")[i])[0].cast("long") for i in range(BANDS * BAND_ROWS)]
    bands = F.array(*[F.xxhash64(F.lit(b), *values[b * BAND_ROWS:(b + 1) * BAND_ROWS]) for b in range(BANDS)])
    buckets = checkpoint(model.transform(hashed).select("key", "doc_id", F.explode(bands).alias("bucket")))
    asked = buckets.where(F.pmod("doc_id", F.lit(ASKED_EVERY)) == 0).select(
        F.col("key").alias("query"), "bucket", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = buckets.select("key", "bucket", F.pmod("key", F.lit(SALTS)).cast("int").alias("salt"))
    pairs = asked.join(dealt, ["bucket", "salt"]).where("query <> key").select("query", "key").distinct()
    left = sets.select(F.col("key").alias("query"), F.col("doc_id").alias("query_id"), F.col("words").alias("a"))
    both = pairs.join(left, "query").join(sets.withColumnRenamed("words", "b"), "key")
    shared = F.size(F.array_intersect("a", "b"))
    far = both.withColumn("distance", 1 - shared / (F.size("a") + F.size("b") - shared)).where(F.col("distance") <= distance)
    return far.select("query_id", "doc_id", F.round("distance", 4).alias("distance"))
