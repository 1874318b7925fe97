import datetime as dt
import gzip
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from stratum import schemas
from stratum.functions import casting
from stratum.sources import files, footers
from tests.conftest import rows, shape

CSV = """c1,c2,c3,c4,c5,c6,c7,c8,c9
1,Ann,a@x,US,REG,2024-01-15,30,F,5
2,NULL,null,,P,2024-02-30,40,M,1
3,"Bo, Jr",b@x,US,R,2024-01-01,20,M,2
x,Cy,c@x,US,R,2024-01-01,20,M,2
5,short
6,long,l@x,US,R,2024-01-01,20,M,2,extra
"""


def test_csv_binds_by_position_and_keeps_bad_lines(spark, landing):
    (landing / "Customer/a.csv").write_text(CSV)
    (landing / "Customer/skip.txt").write_text(CSV)
    df = files.read_csv(spark, str(landing / "Customer"), schemas.CUSTOMER, exact_width=True)
    assert df.columns == [*schemas.CUSTOMER.fieldNames(), casting.CORRUPT]
    got = {r.customer_id: r for r in df.collect()}
    assert set(got) == {"1", "2", "3", "x", "5", "6"}
    assert (got["2"].name, got["2"].email, got["2"].country) == (None, None, None)
    assert got["3"].name == '"Bo'  # no quoting is declared: the comma splits
    assert {k for k, r in got.items() if r[casting.CORRUPT]} == {"3", "5", "6"}


def test_csv_quote_option(spark, landing):
    (landing / "Customer/a.csv").write_text(CSV)
    df = files.read_csv(spark, str(landing / "Customer"), schemas.CUSTOMER, quote='"')
    assert df.where("customer_id = '3'").first().name == "Bo, Jr"


def test_csv_good_and_rejected(spark, landing):
    (landing / "Customer/a.csv").write_text(CSV)
    df = files.read_csv(spark, str(landing / "Customer/a.csv"), schemas.CUSTOMER, exact_width=True)
    good, bad = casting.cast_or_reject(df, schemas.CUSTOMER)
    assert [r.customer_id for r in good.collect()] == [1]
    assert bad.count() == 5  # also when no column is read
    assert good.select('name').count() == 1
    reasons = {r.value for r in bad.select(F.inline("errors")).collect()}
    assert {"2024-02-30", "x", "5,short"} <= reasons


def test_csv_short_and_long_lines_are_loaded(spark, landing):
    (landing / "Customer/a.csv").write_text("a,b\n1,Al,a@x\n2,Bo,b@x,DE,P,2024-01-02,30,M,4,extra,more\n\n3\n")
    df = files.read_csv(spark, str(landing / "Customer/a.csv"), schemas.CUSTOMER)
    good, bad = casting.cast_or_reject(df, schemas.CUSTOMER)
    assert bad.count() == 0 and good.count() == 3
    got = {r.customer_id: (r.email, r.total_purchases) for r in good.collect()}
    assert got == {1: ("a@x", None), 2: ("b@x", 4), 3: (None, None)}


def test_json_one_broken_line_is_one_reject(spark, landing):
    lines = [f'{{"product_id": {i}, "name": "p{i}"}}' for i in range(1000)]
    lines[500] = '{"product_id": }'
    (landing / "Product/a.json").write_text("[" + ",\n".join(lines) + "]")
    df = files.read_json_array(spark, str(landing / "Product"), schemas.PRODUCT)
    good, bad = casting.cast_or_reject(df, schemas.PRODUCT)
    assert good.count() == 999 and [e.value for e in bad.first().errors] == ['{"product_id": },'] and bad.count() == 1


def test_json_whole_lines_are_kept_where_most_are_broken(spark, landing):
    lines = [f'{{"product_id": {i}}}' if i % 5 < 2 else f'{{"product_id": {i}, "na' for i in range(100)]
    (landing / "Product/a b.json").write_text("[" + ",\n".join(lines) + "]")
    spread = '[\n{\n"product_id": 200,\n"extra": [\n{"deep": 1},\n{"deep": 2}\n]\n},\n{\n"product_id": 201\n}\n]'
    (landing / "Product/c.json").write_text(spread)  # a whole object in a line, but the text is JSON
    df = files.read_json_array(spark, str(landing / "Product"), schemas.PRODUCT)
    good, bad = casting.cast_or_reject(df, schemas.PRODUCT)
    assert sorted(r.product_id for r in good.collect()) == [i for i in range(100) if i % 5 < 2] + [200, 201]
    assert bad.count() == 60


def test_json_long_broken_line_is_kept_whole(spark, landing):
    broken = '{"product_id": 2, "name": "' + "x" * 5000
    (landing / "Product/a.json").write_text('{"product_id": 1}\n' + broken)
    df = files.read_json_array(spark, str(landing / "Product"), schemas.PRODUCT)
    _, bad = casting.cast_or_reject(df, schemas.PRODUCT)
    assert [e.value for e in bad.first().errors] == [broken]


def test_json_reject_of_a_whole_file_keeps_its_beginning_only(spark, landing):
    (landing / "Product/a.json").write_text("[\n" + "no json at all\n" * 1000)
    (landing / "Product/b.json").write_text('[\n{\n"product_id": 7,\n"name": "x"\n},\n{\n"product_id": 8\n}\n]')
    df = files.read_json_array(spark, str(landing / "Product"), schemas.PRODUCT)
    good, bad = casting.cast_or_reject(df, schemas.PRODUCT)
    assert sorted(r.product_id for r in good.collect()) == [7, 8]
    assert [len(e.value) for e in bad.first().errors] == [files.EXCERPT] and bad.count() == 1


def test_preview_opens_some_files_only(spark, landing):
    for i in range(5):
        (landing / f"Product/{i}.json").write_text(f'[{{"product_id": {i}}}]' if i < 2 else "broken")
    assert sorted(r.product_id for r in files.preview(spark, files.PRODUCTS, str(landing), files=2).collect()) == ["0", "1"]
    assert files.preview(spark, files.CUSTOMERS, str(landing)).collect() == []


def test_parquet_types_that_disagree_take_few_jobs(spark, landing):
    for i in range(16):
        kind = "string" if i == 11 else "int"
        spark.range(i, i + 1).select(F.col("id").cast(kind).alias("quantity")).coalesce(1).write.parquet(str(landing / f"Order/{i:02d}"))
    good, bad = files.read_parquet_cast(spark, str(landing / "Order"), schemas.struct(quantity=schemas.INT))
    assert sorted(r.quantity for r in good.collect()) == list(range(16)) and bad.count() == 0


@pytest.mark.parametrize("n", [8, 64])
def test_parquet_types_that_alternate_take_jobs_per_kind(spark, landing, monkeypatch, n):
    """Footers are merged once in vain, then once per kind, however many files there are."""
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.int32()]
    for i in range(n):
        kind = kinds[i % 4]
        value = pa.array([str(i) if pa.types.is_string(kind) else i], kind)
        extra = {"store_type": pa.array(["x"])} if i % 4 == 3 else {}
        pq.write_table(pa.table({"quantity": value, **extra}), landing / f"Order/{i:03d} a+b.parquet")
    real, calls = DataFrameReader.parquet, []

    def parquet(self, *paths, **options):
        calls.append(paths)
        return real(self, *paths, **options)

    monkeypatch.setattr(DataFrameReader, "parquet", parquet)
    found = files.read_parquet(spark, str(landing / "Order"), schemas.ORDER)
    assert len(calls) == 4
    assert sorted(int(r.quantity) for r in found.collect()) == list(range(n))
    assert found.where("store_type = 'x'").count() == n // 4


def test_kinds_of_files(spark, landing):
    pq.write_table(pa.table({"a": [1], "b": ["x"]}), landing / "Order/1.parquet")
    pq.write_table(pa.table({"b": ["x"]}), landing / "Order/2.parquet")
    pq.write_table(pa.table({"b": [1]}), landing / "Order/3.parquet")
    (landing / "Order/4.parquet").write_text("no Parquet")
    listed = files.list_files(spark, str(landing / "Order")).select("path")
    groups = [[p[-9] for p in group] for group in footers.groups_that_agree(listed)]
    assert groups == [["1", "2"], ["3"], ["4"]]
    assert footers.groups_that_agree(listed.where("false")) == []


@pytest.mark.parametrize(("path", "address"), [
    ("file:/a b/c%.parquet", "file:///a%20b/c%25.parquet"), ("hdfs://h:8020/a", "hdfs://h:8020/a"),
    ("s3://bucket/x=1/a", "s3://bucket/x%3D1/a"),
])
def test_addresses_of_files(path, address):
    assert footers._address(path) == address


def test_csv_other_suffix_is_skipped_but_compression_is_known(spark, landing):
    with gzip.open(landing / "Customer/a.csv.gz", "wt") as f:
        f.write(CSV)
    folder = str(landing / "Customer")
    assert files.read_csv(spark, folder, schemas.CUSTOMER).count() == 0
    assert files.read_csv(spark, folder, schemas.CUSTOMER, glob="*.csv.gz").count() == 6


def test_csv_name_with_glob_characters(spark, landing):
    (landing / "Customer/a[1]{x}*.csv").write_text(CSV)
    path = str(landing / "Customer/a[1]{x}*.csv")
    assert files.read_csv(spark, path, schemas.CUSTOMER).count() == 6


def test_json_array(spark, landing):
    items = [
        {"product_id": 1, "name": "Pen", "price": "9.5", "rating": None, "is_active": True, "stock_quantity": 3},
        {"product_id": "x", "name": "Bad"},
        {"name": "No id", "price": 1.25},
    ]
    text = json.dumps(items).encode().replace(b"Pen", b"P\xffn")
    (landing / "Product/a.json").write_bytes(text)
    (landing / "Product/broken.json").write_text('[{"product_id":7},{"product_id":}]')
    df = files.read_json_array(spark, str(landing / "Product"), schemas.PRODUCT)
    good, bad = casting.cast_or_reject(df, schemas.PRODUCT)
    got = {r.name: r for r in good.collect()}
    assert set(got) == {"P�n", "No id"}
    first = got["P�n"]
    assert (first.product_id, first.price, first.rating, first.is_active, first.stock_quantity) == (1, 9.5, None, True, 3)
    assert got["No id"].product_id is None
    errors = sorted((r.column, r.value) for r in bad.select(F.inline("errors")).collect())
    assert errors == [("*", '[{"product_id":7},{"product_id":}]'), ("product_id", "x")]


ITEMS = [
    {"product_id": 1, "name": "a } , ] \" \\ { [", "price": 1.25, "stock_quantity": 2, "rating": -1.50, "is_active": True},
    {"product_id": 2, "name": None, "extra": {"deep": [1, {"x": "}"}]}},
    {"product_id": 3, "name": "\u00e9\n", "price": "7"},
    {},
]
EXPECTED = [
    (1, 'a } , ] " \\ { [', 1.25, 2, -1.5, True), (2, None, None, None, None, None),
    (3, "\u00e9\n", 7.0, None, None, None), (None,) * 6,
]


@pytest.mark.parametrize("text", [
    json.dumps(ITEMS),  # all in one line
    json.dumps(ITEMS, indent=2),  # spread over lines
    "[" + ",\n".join(map(json.dumps, ITEMS)) + "]",
    "[\n" + "\n, ".join(map(json.dumps, ITEMS)) + "\n]\n",
    "\n\n".join(map(json.dumps, ITEMS)),  # no array around the objects
    "[" + ",\n".join(map(json.dumps, ITEMS)),  # the end of the array is lost, the elements are not
    "\ufeff" + json.dumps(ITEMS[:2])[:-1] + ",\r\n" + json.dumps(ITEMS[2:])[1:],
])
def test_json_layouts(spark, landing, text):
    (landing / "Product/a[1] b.json").write_text(text, newline="")
    df = files.read_json_array(spark, str(landing / "Product"), schemas.PRODUCT)
    good, bad = casting.cast_or_reject(df, schemas.PRODUCT)
    fields = ["product_id", "name", "price", "stock_quantity", "rating", "is_active"]
    assert rows(good.select(fields)) == sorted(EXPECTED, key=lambda r: [(v is not None, str(v)) for v in r])
    assert bad.count() == 0
    assert df.count() == 4


@pytest.mark.parametrize("text", [
    '[{"product_id": 1}, {"product_id": 2', '{"product_id": 1\n}\n{"product_id": 2\n}', "[1, {", "junk", '{"product_id": 1}}',
])
def test_json_that_is_not_valid_is_rejected_not_cut(spark, landing, text):
    (landing / "Product/bad.json").write_text(text)
    (landing / "Product/good.json").write_text('[{"product_id": 9}]')
    (landing / "Product/empty.json").write_text("")
    df = files.read_json_array(spark, str(landing / "Product"), schemas.PRODUCT)
    good, bad = casting.cast_or_reject(df, schemas.PRODUCT)
    assert [r.product_id for r in good.collect()] == [9]
    assert [r.value for r in bad.select(F.inline("errors")).collect()] == [text]


def test_large_json_file_is_read_by_many_tasks(spark, landing):
    with open(landing / "Product/big.json", "w") as f:
        f.write("[" + ",\n".join(json.dumps({"product_id": i}) for i in range(20_000)) + "]")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        df = files.read_json_array(spark, str(landing / "Product"), schemas.PRODUCT)
        assert df.rdd.getNumPartitions() > 5
        assert df.select(F.sum(F.col("product_id").cast("long")), F.count("*")).first()[:] == (19_999 * 10_000, 20_000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def order_table(**changes):
    columns = {
        "payment_method": ["Card", " Pay "], "quantity": ["1", "2"], "transaction_id": ["T1", "T2"],
        "transaction_date": [dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 2, 6)],
        "customer_id": [1, 2], "product_id": [3, 4], "total_amount": [1.5, 2.5], "store_type": ["a", "b"],
    }
    return pa.table({k: v for k, v in {**columns, **changes}.items() if v is not None})


def test_parquet_by_name_with_casts(spark, landing):
    pq.write_table(order_table(quantity=["1", "two"]), landing / "Order/a.parquet")
    good, bad = files.read_parquet_cast(spark, str(landing / "Order"), schemas.ORDER)
    assert shape(good.schema) == shape(schemas.ORDER)
    assert rows(good) == [("T1", 1, 3, 1, "a", 1.5, dt.date(2024, 1, 1), "Card")]
    assert [(e.column, e.value) for e in bad.first().errors] == [("quantity", "two")]
    assert bad.first().payment_method == " Pay "  # nothing is trimmed


def test_parquet_missing_column_is_null(spark, landing):
    pq.write_table(order_table(store_type=None), landing / "Order/a.parquet")
    good, bad = files.read_parquet_cast(spark, str(landing / "Order"), schemas.ORDER)
    assert {r.store_type for r in good.collect()} == {None}
    assert bad.count() == 0


def test_parquet_files_that_disagree_on_a_type(spark, landing):
    pq.write_table(order_table(), landing / "Order/a.parquet")
    pq.write_table(order_table(quantity=[5, 6], transaction_id=["T3", "T4"], store_type=None), landing / "Order/b.parquet")
    good, bad = files.read_parquet_cast(spark, str(landing / "Order"), schemas.ORDER)
    assert {(r.transaction_id, r.quantity, r.store_type) for r in good.collect()} == {
        ("T1", 1, "a"), ("T2", 2, "b"), ("T3", 5, None), ("T4", 6, None)}
    assert bad.count() == 0
    assert {r.transaction_date for r in good.collect()} == {dt.date(2024, 1, 1), dt.date(2024, 1, 2)}


def test_preview(spark, landing):
    (landing / "Customer/a.csv").write_text(CSV)
    (landing / "Product/a.json").write_text('[{"product_id": 1}, {"product_id": 2}]')
    pq.write_table(order_table(), landing / "Order/a.parquet")
    assert files.preview(spark, files.CUSTOMERS, str(landing), 2).count() == 2
    assert files.preview(spark, files.PRODUCTS, str(landing)).count() == 2
    assert files.preview(spark, files.ORDERS, str(landing), 1).count() == 1


def test_list_landing(spark, landing):
    (landing / "Customer/a.csv").write_text(CSV)
    (landing / "Order/n.txt").write_text("12345")
    listed = files.list_landing(spark, str(landing))
    assert listed.columns == ["path", "modificationTime", "length"]
    assert {(r.path.rsplit("/", 1)[1], r.length) for r in listed.collect()} == {("a.csv", len(CSV)), ("n.txt", 5)}
    assert files.list_landing(spark, str(landing), "Customer").count() == 1


def test_paths_outside_the_landing_root_are_refused(spark, landing, tmp_path):
    (tmp_path / "landing2").mkdir()
    (tmp_path / "landing2/a.csv").write_text(CSV)
    for path in (tmp_path / "landing2/a.csv", landing / "../landing2/a.csv"):
        with pytest.raises(PermissionError):
            files.read_csv(spark, str(path), schemas.CUSTOMER, landing_root=str(landing))
    with pytest.raises(PermissionError):
        files.list_landing(spark, str(landing), "../landing2")
