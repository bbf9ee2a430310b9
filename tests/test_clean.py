from pyspark.sql import Row
from pyspark.sql import functions as F

from vitrine.functions.numeric import text_to_double
from vitrine.operators import clean as C
from vitrine.operators.features import derive, normalize
from vitrine.schema import canonicalize


def test_number_spellings(spark):
    texts = ["12,50", "1,234.56", "nan", "inf", " 12 ", "None", "", None, "1.0d", "-3", "1e2", ".5"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.n for r in df.select("i", text_to_double(F.col("t")).alias("n")).orderBy("i").collect()]
    assert got == [12.5, None, None, None, 12.0, None, None, None, None, -3.0, 100.0, 0.5]


def test_alias_never_takes_a_canonical_column(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Prix int, score int, rating int")
    assert canonicalize(df).columns == ["price", "score", "rating"]
    df = spark.createDataFrame([(1, 2)], "note int, customer_reviews int")
    assert canonicalize(df).columns == ["rating", "customer_reviews"]


def test_keep_last_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "a", 2), ("x", "a", 3), ("x", None, 4), ("x", None, 5)],
                               "product_id string, title string, pos int")
    got = {(r.product_id, r.title, r.pos) for r in C.keep_last(df, ["product_id", "title"], ["pos"]).collect()}
    assert got == {(None, "a", 2), ("x", "a", 3), ("x", None, 5)}


def test_keep_last_prunes_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("product_id"), F.lit("t").alias("title"), F.col("id").alias("pos"))
    plan = C.keep_last(df, ["product_id", "title"], ["pos"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dedupe_first_keeps_rows_without_key(spark):
    rows = [("", "", "", 1), ("", "", "", 2), ("a", "u", "t", 3), ("a", "v", "s", 4), ("", "u", "", 5), ("", "u", "z", 6)]
    df = spark.createDataFrame(rows, "product_id string, url string, title string, pos int")
    assert sorted(r.pos for r in C.dedupe_first(df, ["pos"]).collect()) == [1, 2, 3, 5]


def test_dedupe_is_idempotent(spark):
    df = spark.createDataFrame([("a", "t", 1), ("a", "t", 2), ("b", "t", 3)], "product_id string, title string, pos int")
    once = C.keep_last(df, ["product_id", "title"], ["pos"])
    assert sorted(C.keep_last(once, ["product_id", "title"], ["pos"]).collect()) == sorted(once.collect())


def flags(spark, rows):
    df = spark.createDataFrame([Row(rating=r, review_count=v) for r, v in rows], "rating double, review_count double")
    return C.column_flags(df).first()


def test_flags(spark):
    assert flags(spark, [(None, None), (None, None)]).rating_synthetic
    assert flags(spark, [(0.0, 1.0), (0.0, 0.0)]).rating_synthetic
    mixed = flags(spark, [(0.0, 1.0), (None, None)])
    assert not mixed.rating_synthetic and not mixed.reviews_synthetic
    assert flags(spark, [(4.0, 1.0), (None, 0.0)]).reviews_synthetic


def test_synthetic_fill_does_not_depend_on_partitions(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("product_id"), F.lit("t").alias("title"),
                                 F.lit(None).cast("double").alias("rating"), F.lit(None).cast("double").alias("review_count"))
    one = sorted(C.impute(df.repartition(1)).collect())
    many = sorted(C.impute(df.repartition(7)).collect())
    assert one == many
    ratings = [r.rating for r in one]
    assert min(ratings) >= 2.5 and max(ratings) <= 5.0 and 4.0 < sum(ratings) / 500 < 4.5
    assert all(r.review_count >= 0 and 10 * r.review_count <= r.traffic < 100 * r.review_count + 1 for r in one)


def test_traffic_without_reviews(spark):
    df = spark.createDataFrame([("a", "t", "5")], "product_id string, title string, price string")
    assert C.clean(df).first().traffic == 0.0


def test_features_of_a_constant_column_are_zero(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "price double, rating double")
    got = normalize(df).orderBy("rating").collect()
    assert [(r.price_norm, r.rating_norm) for r in got] == [(0.0, 0.0), (0.0, 1.0)]


def test_availability_patterns(spark):
    texts = ["in stock", "instock", "indisponible", "disponible", "TRUE", "no", None]
    df = spark.createDataFrame([(t,) for t in texts], "availability string")
    loose = {r.availability: r.disponible for r in derive(df).collect()}
    strict = {r.availability: r.disponible for r in derive(df, strict=True).collect()}
    assert [loose[t] for t in texts] == [1, 0, 1, 1, 1, 0, 0]
    assert [strict[t] for t in texts] == [1, 1, 0, 1, 1, 0, 0]


def test_ratio_without_rating(spark):
    df = spark.createDataFrame([(5.0, 0.0), (6.0, 2.0), (7.0, None)], "price double, rating double")
    assert sorted(r.prix_par_rating for r in derive(df).collect()) == [3.0, 5.0, 7.0]
