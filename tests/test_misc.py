import os
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from vitrine.functions import text as T
from vitrine.functions import web as W
from vitrine.operators import access as A
from vitrine.operators import filters as L
from vitrine.operators import score as K
from vitrine.operators import supervised as M
from vitrine.schema import RAW_FIELDS
from vitrine.session import fresh_path
from vitrine.sources import audit, pages, payloads, raw, stage
from vitrine.streaming import audit_tail, ingest


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_weights():
    assert K.effective_weights() == pytest.approx(K.DEFAULT_WEIGHTS)
    assert K.effective_weights({k: 0 for k in K.DEFAULT_WEIGHTS}) == {k: 0.0 for k in K.DEFAULT_WEIGHTS}
    assert sum(abs(v) for v in K.effective_weights({"price": -5}).values()) == pytest.approx(1)


def test_weight_falls_back_to_the_raw_column(spark):
    df = spark.createDataFrame([(2.0, 0.5)], "price double, rating_norm double")
    assert K.score_columns(df)["price"][0] == "price" and K.score_columns(df)["rating"][0] == "rating_norm"
    assert set(K.score_columns(df)) == {"price", "rating"}
    assert K.composite_score(df).first().composite_score == pytest.approx(-0.2 * 2 + 0.4 * 0.5)


def test_top_k(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None), ("d", 2.0)], "product_id string, composite_score double")
    assert [(r.product_id, r["rank"]) for r in K.top_k(df, 4).orderBy("rank").collect()] == [("d", 1), ("a", 2), ("b", 3), ("c", 4)]
    with pytest.raises(KeyError):
        K.top_k(df, 1, "nope")
    assert "TakeOrderedAndProject" in K.top_k(df, 2)._jdf.queryExecution().executedPlan().toString()


def test_search_ignores_nulls(spark):
    df = spark.createDataFrame([("1", None), ("2", "nan bread")], "product_id string, title string")
    assert [r.product_id for r in L.search(df, "NaN").collect()] == ["2"]


def test_non_physical(spark):
    rows = [("Shoe", "", "10"), ("Theme pack", "", "10"), ("Sac", "x" * 600 + " plugin", "10"), ("éapi", "", "1500,01"),
            ("appé", "", "dear")]
    df = spark.createDataFrame(rows, "title string, description string, price string")
    assert {r.title for r in L.drop_non_physical(df, L.DESCRIPTION_LEAD).collect()} == {"Shoe", "Sac", "appé"}
    assert {r.title for r in L.drop_non_physical(df).collect()} == {"Shoe", "appé"}


def test_text(spark):
    assert one(spark, T.strip_html(F.lit(" <p>a &amp;lt; b\n</p> "))) == "a &lt; b"
    assert one(spark, T.strip_html(F.lit("<b>caf&eacute;&nbsp;</b>"), True)) == "café"
    assert one(spark, T.short_summary(F.lit("n"), F.lit(" ".join("abcdefghijklmnopqrstu")))).endswith("t…")
    assert one(spark, T.short_summary(F.lit("n"), F.lit(""))) == "n"
    answer = "Intro\n- Trend one\n\n2. Second trend.\n• ok\n3. Third trend here\n4. Fourth trend"
    assert one(spark, T.parse_answer(F.lit(answer))) == ["Trend one", "Second trend", "Third trend here"]


def test_entities_without_semicolon_stay(spark):
    text = "<p>A &amp; B&middot;&#39;&#x41;&nosuch; C &copy D &amp</p>"
    assert one(spark, T.strip_html(F.lit(text), True, unterminated=False)) == "A & B·'A&nosuch; C &copy D &amp"
    assert one(spark, T.strip_html(F.lit(text), True)) == "A & B·'A&nosuch; C © D &"


def test_urls(spark):
    def platform(u):
        return one(spark, W.platform_of(F.lit(u)))

    assert platform("https://a.MyShopify.com/x") == "shopify"
    assert platform("https://a.b/wp-json/wc/v2/products") == "woocommerce"
    assert platform("https://a.b/products.json") == "shopify"
    assert platform("not a url") == "generic"
    assert one(spark, W.shop_base(F.lit("brand"))) == "https://brand.myshopify.com"


def test_minor_units(spark):
    body = '{"id": 1, "prices": {"price": "1999", "currency_minor_unit": 2}}'
    df = spark.createDataFrame([(body,)], "p string")
    assert payloads.normalize_store_api(df, "p").first().price == "1999"
    assert payloads.normalize_store_api(df, "p", minor_units=True).first().price == "19.99"


def test_first_variant_wins_even_if_blank(spark):
    df = spark.createDataFrame([('{"id": 3, "price": "9", "variants": [{"sku": "x"}], "images": ["a.png"]}',)], "p string")
    row = payloads.normalize_generic(df, "p", "generic").first()
    assert (row.product_id, row.price, row.image_url, row.title) == ("3", "", "a.png", "")
    assert tuple(df.transform(lambda d: payloads.normalize_generic(d, "p", "g")).columns) == RAW_FIELDS


def test_on_sale(spark):
    assert one(spark, payloads.is_on_sale(F.lit("5"), F.lit("6")))
    assert not one(spark, payloads.is_on_sale(F.lit(""), F.lit("6")))
    assert not one(spark, payloads.is_on_sale(F.lit("6"), F.lit("6")))


def test_cards():
    html = ('<div class="product-card" id="product-7"><a href="/p/7"><img data-src="i.png"></a><h3>Name <b>bold</b></h3>'
            '<span class="sale-price">from 1,50 €</span></div><div data-product="1"><p class="name">Two</p></div>')
    first, second = pages.parse_cards(html)
    assert first == {"id": "7", "href": "/p/7", "image": "i.png", "title": "Namebold", "price": "from 1,50 €"}
    assert second == {"id": "", "title": "Two"}


def raw_batches(spark):
    root = fresh_path(spark, "raw")
    first = spark.createDataFrame([("1", "a", 'say ""hi""\n<p>two</p>', "12,50"), ("2", "b", " x ", "None"), (None, "n", "", "1"),
                                   (None, "n", "", "2")], "product_id string, title string, description string, price string")
    raw.write_batch(first.coalesce(1), root, "shopify", datetime(2026, 1, 1))
    second = spark.createDataFrame([("1", "a", "new", "13")], first.schema)
    raw.write_batch(second, root, "woocommerce", datetime(2026, 1, 2))
    return root


def test_raw_batches_and_stream_agree(spark):
    root = raw_batches(spark)
    batch = raw.load_raw(spark, root + "/*.csv/*.csv")
    got = {(r.product_id, r.title): r for r in batch.collect()}
    assert set(got) == {("1", "a"), ("2", "b"), (None, "n")}
    assert got["1", "a"].description == "new" and got["1", "a"]._source_file == "woocommerce_20260102_000000.csv"
    assert got["2", "b"].price is None and got["2", "b"].description == " x " and got[None, "n"].price == "2"
    sink, state = fresh_path(spark, "bronze"), fresh_path(spark, "state")
    ingest.start_ingest(spark, root + "/*.csv", sink, state).awaitTermination()
    assert sorted(map(str, ingest.current(spark, sink).select(batch.columns).collect())) == sorted(map(str, batch.collect()))
    late = spark.createDataFrame([("2", "b", "late", "9")], "product_id string, title string, description string, price string")
    raw.write_batch(late, root, "woocommerce", datetime(2026, 1, 3))
    ingest.start_ingest(spark, root + "/*.csv", sink, state).awaitTermination()
    now = ingest.current(spark, sink)
    assert now.count() == 3 and now.filter("product_id = '2'").first().price == "9"


def csv_file(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def folders(table):
    return {(int(v[8:]), int(b[7:])) for v in os.listdir(f"{table}/buckets=8") for b in os.listdir(f"{table}/buckets=8/{v}") if b.startswith("bucket=")}


def test_stream_takes_columns_by_name_and_rewrites_touched_buckets(spark, tmp_path):
    raw_dir, sink, state = (str(tmp_path / n) for n in ("raw", "table", "state"))

    def ingested():
        ingest.start_ingest(spark, raw_dir, sink, state, buckets=8).awaitTermination()
        return {r.product_id: r for r in ingest.current(spark, sink).collect()}

    csv_file(raw_dir, "a.csv", "product_id,title,price", *[f"{i},t{i},{i}.5" for i in range(40)])
    csv_file(raw_dir, "b.csv", "extra,price,title,product_id", "x,99,t1,1", 'y,"7,5",t50,50')
    first = ingested()
    assert len(first) == 41 and first["1"].price == "99" and first["1"].extra == "x" and first["50"].price == "7,5" and first["2"].extra is None
    assert first["2"].brand is None and set(RAW_FIELDS) < set(first["2"].asDict())
    before = folders(sink)
    assert {v for v, _ in before} == {0} and ingested() == first and folders(sink) == before
    csv_file(raw_dir, "c.csv", "title,product_id", "t2,2")
    csv_file(raw_dir, "Z.csv", "title,product_id,brand", "t3,3,late")  # sorts before a.csv: its row is older than what is held
    second = ingested()
    assert second["2"].price is None and second["3"].price == "3.5" and second["3"].brand is None and second["50"] == first["50"]
    touched = {b for v, b in folders(sink) if v == 1}
    assert 1 <= len(touched) <= 2 and folders(sink) - {(1, b) for b in touched} == before
    assert {r.product_id for b in range(8) for r in ingest.current(spark, sink, [b]).collect()} == set(second)
    with pytest.raises(StreamingQueryException, match="another checkpoint"):
        ingest.start_ingest(spark, raw_dir, sink, str(tmp_path / "other"), buckets=8).awaitTermination()


def test_replayed_and_unfinished_versions(spark, tmp_path):
    table = str(tmp_path / "table")

    def rows(*values):
        return spark.createDataFrame([(i and str(i), f"t{i}", price, path, 0, 0) for i, price, path in values],
                                     "product_id string, title string, price string, _path string, _block long, _row long")

    def held():
        return {r.product_id: r.price for r in ingest.current(spark, table).collect()}

    ingest.upsert(rows((1, "a", "f1"), (2, "a", "f1")), table, 0, 4)
    ingest.upsert(rows((1, "b", "f2")), table, 1, 4)
    assert held() == {"1": "b", "2": "a"}
    # The write of version 2 breaks off: readers still see version 1, and the replay starts from it.
    (bucket,) = ingest.upsert(rows((1, "broken", "f3")), table, 2, 4)
    os.remove(f"{table}/buckets=4/version=2/_SUCCESS")
    assert held() == {"1": "b", "2": "a"}
    assert ingest.upsert(rows((1, "c", "f3")), table, 2, 4) == [bucket] and held() == {"1": "c", "2": "a"}
    assert ingest.upsert(rows((1, "c", "f3")), table, 2, 99) == [bucket] and held() == {"1": "c", "2": "a"}
    ingest.upsert(rows((1, "d", "f4")), table, 3, 4)
    assert ingest.vacuum(spark, table) >= 1 and held() == {"1": "d", "2": "a"}
    ingest.upsert(rows((1, "e", "f4"), (None, "n", "f4")), table, 3, 4)
    assert held() == {"1": "e", "2": "a", None: "n"}


def test_quoted_text_survives(spark):
    root = raw_batches(spark)
    rows = raw.read_raw(spark, root + "/shopify*.csv/*.csv")
    assert rows.filter("product_id = '1'").first().description == 'say ""hi""\n<p>two</p>'


def test_uneven_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("product_id,title,price\n1,a,2\n")
    (tmp_path / "b.csv").write_text("title,product_id,brand\nb,2,z\n")
    (tmp_path / "c.csv").write_text("product_id,title,price\n")
    got = {(r.product_id, r.title, r.price, r.brand, r._source_file) for r in raw.load_raw(spark, f"{tmp_path}/*.csv").collect()}
    assert got == {("1", "a", "2", None, "a.csv"), ("2", "b", None, "z", "b.csv")}
    with pytest.raises(FileNotFoundError):
        raw.load_raw(spark, f"{tmp_path}/*.none")


def test_stage_fallbacks(spark):
    with pytest.raises(FileNotFoundError):
        stage.read_first(spark, fresh_path(spark, "none"))
    path = fresh_path(spark, "plain")
    stage.write_stage(spark.createDataFrame([("b",), ("a",)], "product_id string"), path)
    assert [r[0] for r in stage.read_top_k(spark, fresh_path(spark, "top"), path, k=1).collect()] == ["a"]
    with pytest.raises(ValueError):
        stage.export(spark.range(1), path, "xlsx")


def test_audit(spark, tmp_path):
    lines = ['{"event": "execute", "tool": "get_top_k", "role": "viewer", "params": {"k": 5}, "_timestamp": "1"}', "{broken",
             '{"event": "denied", "tool": "export_data", "role": "viewer", "_timestamp": "2"}']
    (tmp_path / "log.jsonl").write_text("\n".join(lines) + "\n")
    log = audit.read_audit(spark, str(tmp_path))
    assert log.count() == 2
    roles = audit.role_table(spark)
    assert [r.tool for r in A.visible_logs(log, roles, "viewer").collect()] == ["get_top_k"]
    assert [r["class"] for r in A.recent_entries(log).collect()] == ["denied", "other"]
    sink = fresh_path(spark, "alerts")
    audit_tail.start_tail(audit_tail.audit_stream(spark, str(tmp_path)), sink, fresh_path(spark, "state")).awaitTermination()
    assert [r.tool for r in spark.read.parquet(sink).collect()] == ["export_data"]
    assert {r["role"]: r["count"] for r in roles.groupBy("role").count().collect()} == {"viewer": 4, "analyst": 6, "admin": 8}


def test_role_file(spark, tmp_path):
    (tmp_path / "roles.json").write_text('{"roles": {"viewer": {"description": "d", "tools": ["a", "b"]}},\n "tools": {"a": '
                                         '{"description": "x", "input_schema": {"k": "number"}, "requires_logging": true}}}')
    path = str(tmp_path / "roles.json")
    assert sorted(tuple(r) for r in audit.read_roles(spark, path).collect()) == [("viewer", "d", "a"), ("viewer", "d", "b")]
    assert audit.read_tools(spark, path).first().parameters == ["k"]


def test_split_is_stratified_and_stable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("product_id"), (F.col("id") % 10 == 0).cast("int").alias(M.TARGET))
    got = M.split(df.repartition(3))
    sizes = {(r[M.TARGET], r.is_test): r["count"] for r in got.groupBy(M.TARGET, "is_test").count().collect()}
    assert sizes == {(0, True): 270, (0, False): 630, (1, True): 30, (1, False): 70}
    assert sorted(got.collect()) == sorted(M.split(df.repartition(8)).collect())


def test_score_column(spark):
    assert M.score_column(spark.createDataFrame([(1, 2)], "rating_norm int, score int")) == "score"
    with pytest.raises(KeyError):
        M.score_column(spark.range(1))


def test_boosting_reads_equal_rows_once(spark):
    from pyspark.ml.classification import GBTClassifier
    from vitrine.operators import supervised as M

    class Seen(GBTClassifier):
        def fit(self, rows, params=None):
            self.rows = rows.count()
            return super().fit(rows)

    data = [(i * 100 + c, f"t{i}", float(i % 7), float(i % 11), int(i % 7 > 3)) for i in range(77) for c in range(6)]
    df = spark.createDataFrame(data, f"product_id int, title string, a double, b double, {M.TARGET} int")
    rows = M.with_weights(M.assembled(df, ["a", "b"]), False)
    one = Seen(featuresCol="_features", labelCol=M.TARGET, weightCol="_weight", maxIter=3, maxDepth=3, seed=1)
    whole, merged = GBTClassifier.fit(one, rows), M.fitted(one, rows)
    assert one.rows == 77
    assert M.predict(whole, rows).select("product_id", "prediction").exceptAll(M.predict(merged, rows).select("product_id", "prediction")).isEmpty()
