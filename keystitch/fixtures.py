"""Feeds and reference tables derived from the driver's tables (FIXTURES.md).

Every fixture is a Spark plan over the given parquet tables, so its work grows
with the scale factor; nothing here is made-up data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .spec import EnrichSpec


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's (read-only) tables; the DataFrame is created once
    per application so its file listing and footer read happen once."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return _TABLES[key]


# X1 ------------------------------------------------------------------------
# Feed = open line items under the job's untidy headers; reference = finished
# line items under the canonical names. Travel_Sector 'R' is blanked in the
# feed so a third of its rows carry an empty key part.

X1_ORDER_BY = ("Booking_Date", "Invoice_Number", "l_suppkey")


def x1_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.filter(F.col("l_linestatus") == "O").select(
        F.col("l_orderkey").alias("Airline PNR/Prov. Booking"),
        F.col("l_linenumber").alias(" AIRLINE code "),
        F.when(F.col("l_returnflag") == "R", F.lit(" ")).otherwise(F.col("l_returnflag")).alias("Sector"),
        F.col("l_quantity").alias("Qty"),
        F.col("l_partkey"),
        F.col("l_suppkey"),
    )


def x1_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.filter(F.col("l_linestatus") == "F").select(
        F.col("l_orderkey").alias("PNR_Number"),
        F.col("l_linenumber").alias("Airline_Code"),
        F.col("l_returnflag").alias("Travel_Sector"),
        F.col("l_extendedprice").alias("Taxable_Amount"),
        F.col("l_discount").alias("NonTaxable_Amount"),
        F.col("l_tax").alias("Cgst_Total"),
        F.col("l_shipdate").alias("Booking_Date"),
        F.col("l_partkey").alias("Invoice_Number"),
        F.col("l_suppkey"),
    )


def x1_spec(reference: DataFrame | None = None) -> EnrichSpec:
    cols = reference.columns if reference is not None else [
        "Taxable_Amount", "NonTaxable_Amount", "Cgst_Total", "Booking_Date", "Invoice_Number"]
    return EnrichSpec(order_by=X1_ORDER_BY).with_targets(cols)


# SQL twins of the X1 fixtures, for the DuckDB oracle.
X1_FEED_SQL = """
SELECT l_orderkey AS "Airline PNR/Prov. Booking",
       l_linenumber AS " AIRLINE code ",
       CASE WHEN l_returnflag = 'R' THEN ' ' ELSE l_returnflag END AS "Sector",
       l_quantity AS "Qty", l_partkey, l_suppkey
FROM lineitem WHERE l_linestatus = 'O'
"""

X1_REF_SQL = """
SELECT l_orderkey AS PNR_Number, l_linenumber AS Airline_Code, l_returnflag AS Travel_Sector,
       l_extendedprice AS Taxable_Amount, l_discount AS NonTaxable_Amount, l_tax AS Cgst_Total,
       l_shipdate AS Booking_Date, l_partkey AS Invoice_Number, l_suppkey
FROM lineitem WHERE l_linestatus = 'F'
"""

X1_FIRST_SQL = f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY PNR_Number, Airline_Code, Travel_Sector
                               ORDER BY Booking_Date NULLS FIRST, Invoice_Number NULLS FIRST,
                                        l_suppkey NULLS FIRST,
                                        Taxable_Amount NULLS FIRST, NonTaxable_Amount NULLS FIRST,
                                        Cgst_Total NULLS FIRST) AS rn
  FROM ({X1_REF_SQL}) r
  WHERE PNR_Number IS NOT NULL AND Airline_Code IS NOT NULL AND Travel_Sector IS NOT NULL
) WHERE rn = 1
"""

X1_VALID = """("Airline PNR/Prov. Booking" IS NOT NULL AND " AIRLINE code " IS NOT NULL
   AND "Sector" IS NOT NULL AND regexp_matches("Sector", '^\\s*$') = false)"""


# X3 ------------------------------------------------------------------------
# A CSV feed directory written by Spark from `orders`: one file per
# (o_orderstatus, o_orderpriority) group and key range, rows in o_orderkey order. The three
# statuses use three layouts (different header spellings, column order, a
# blank header, a duplicate header, a leading blank line, a layout without a
# sector column). Plus a header-only file, a zero-byte file, a .txt file and a
# sub-directory, which the job must report or ignore.

X3_LAYOUTS = {
    # status: (header labels, value fields, leading blank line)
    "F": (["Airline PNR", "Airline Code", "Sector", "Amount", "Order Date", ""],
          ["key", "cust", "sector", "price", "date", "status"], False),
    "O": (["sector", "Order Date", "PNRNUMBER", "airlinecode", "Amount", "Amount"],
          ["sector", "date", "key", "cust", "price", "cust"], True),
    "P": (["Airline PNR", "Airline Code", "Amount"], ["key", "cust", "price"], False),
}
X3_HEADER_ONLY = "header_only.csv"
X3_EMPTY = "empty.csv"


# Orders of so many keys share a file per group: the number of files grows with
# the table, the rows of a file do not.
X3_KEYS_PER_FILE = 200_000


def x3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, line) of all files, headers and leading blank lines included, in
    file order within a name. Built-in functions only."""
    o = table(spark, sf_dir, "orders")
    sector = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("NA")).otherwise(F.col("o_orderpriority"))
    cells = {"key": F.col("o_orderkey").cast("string"), "cust": F.col("o_custkey").cast("string"),
             "sector": sector,   # '5-LOW' rows carry the NA token instead of a sector: an empty key
             "price": F.col("o_totalprice").cast("string"), "date": F.date_format("o_orderdate", "yyyy-MM-dd"),
             "status": F.col("o_orderstatus")}
    line = head = lead = F.lit(None).cast("string")
    for status, (labels, fields, blank) in X3_LAYOUTS.items():
        mine = F.col("o_orderstatus") == status
        line = F.when(mine, F.concat_ws(",", *[cells[f] for f in fields])).otherwise(line)
        head = F.when(mine, F.lit(",".join(labels))).otherwise(head)
        lead = F.when(mine & F.lit(blank), F.lit("")).otherwise(lead)
    name = F.format_string("orders_%s_%s_%d", "o_orderstatus", F.replace("o_orderpriority", F.lit(" "), F.lit("_")),
                           F.floor(F.col("o_orderkey") / X3_KEYS_PER_FILE).cast("bigint"))
    rows = o.select(name.alias("name"), F.col("o_orderkey").cast("bigint").alias("seq"), line.alias("value"))
    tops = o.select(name.alias("name"), head.alias("head"), lead.alias("lead")).distinct()
    tops = tops.select("name", F.inline(F.array(F.struct(F.lit(-2).cast("bigint").alias("seq"), F.col("lead").alias("value")),
                                                F.struct(F.lit(-1).cast("bigint").alias("seq"), F.col("head").alias("value")))))
    both = rows.unionByName(tops.where("value is not null"))
    return both.repartition("name").sortWithinPartitions("name", "seq").select("name", "value")


def build_x3(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write the X3 directory under ``root``; returns the feed folder."""
    from .sources.files import hadoop_glob, hadoop_mkdirs, hadoop_rename, hadoop_write_text

    staging, feeds = f"{root}/staging", f"{root}/feeds"
    x3_lines(spark, sf_dir).write.mode("overwrite").partitionBy("name").text(staging)
    hadoop_mkdirs(spark, feeds)
    for part in hadoop_glob(spark, f"{staging}/name=*/part-*"):
        hadoop_rename(spark, part, f"{feeds}/{_unescape(part.split('/')[-2].split('=', 1)[1])}.csv")
    hadoop_write_text(spark, f"{feeds}/{X3_HEADER_ONLY}", "Airline PNR,Airline Code,Sector,Amount\n")
    hadoop_write_text(spark, f"{feeds}/{X3_EMPTY}", "")
    hadoop_write_text(spark, f"{feeds}/notes.txt", "not a feed\n")
    hadoop_mkdirs(spark, f"{feeds}/archive")
    hadoop_write_text(spark, f"{feeds}/archive/old.csv", "Airline PNR,Airline Code,Sector\n1,2,3\n")
    return feeds


def _unescape(v: str) -> str:
    from urllib.parse import unquote
    return unquote(v)


def x3_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` under canonical names (keys bigint/bigint/string)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("PNR_Number"), F.col("o_custkey").alias("Airline_Code"),
        F.col("o_orderpriority").alias("Travel_Sector"), F.col("o_totalprice").alias("Taxable_Amount"),
        F.col("o_orderdate").alias("Booking_Date"))


def x3_spec() -> EnrichSpec:
    return EnrichSpec(order_by=("Booking_Date",)).with_targets(["Taxable_Amount", "Booking_Date"])


# SQL twin: one row per X3 data row with the file it lands in.
X3_ROWS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate,
       'orders_' || o_orderstatus || '_' || replace(o_orderpriority, ' ', '_') || '_' || (o_orderkey // 200000) || '.csv' AS name,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS sector
FROM orders"""


# X5 ------------------------------------------------------------------------
# Workbooks written from `nation`, `region` and `customer`: book_a with a sheet
# under two title rows, a two-column sheet and an empty sheet, and a book_b_<n>
# per X5_KEYS_PER_BOOK customers with a keyed sheet that the job can enrich and
# a sheet whose header row holds a number. Their number grows with the table,
# the rows of one do not.

X5_KEYS_PER_BOOK = 1000
X5_SHEETS = {"book_a": ["Nations", "Regions", "Empty"], "book_b": ["Customers", "Numbers"]}


def x5_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per written sheet row: book, sheet, row order key, cell texts
    and which cells are numbers. Title and header rows come first (order 0-2),
    data rows follow in key order (order = key + 100)."""
    def lit_rows(book, sheet, pos, lines):
        out = [(book, sheet, pos, i, [None if v is None else str(v) for v in vals],
                [not isinstance(v, str) for v in vals]) for i, vals in enumerate(lines)]
        return spark.createDataFrame(out, "book string, sheet string, sheet_pos int, row_pos bigint, "
                                          "vals array<string>, nums array<boolean>")

    def data_rows(df, book, sheet, pos, cells, nums):
        return df.select((F.lit(book) if isinstance(book, str) else book).alias("book"), F.lit(sheet).alias("sheet"), F.lit(pos).alias("sheet_pos"),
                         (cells[0].cast("bigint") + F.lit(100)).alias("row_pos"),
                         F.array(*[x.cast("string") for x in cells]).alias("vals"),
                         F.array(*[F.lit(n) for n in nums]).alias("nums"))

    nation, region, cust = (table(spark, sf_dir, t) for t in ("nation", "region", "customer"))
    book_b = F.format_string("book_b_%d.xlsx", F.floor(F.col("c_custkey") / X5_KEYS_PER_BOOK).cast("bigint"))

    def heads(sheet, pos, cells):
        """The header row of a sheet of each book_b."""
        return cust.select(book_b.alias("book")).distinct().select(
            "book", F.lit(sheet).alias("sheet"), F.lit(pos).alias("sheet_pos"), F.lit(0).cast("bigint").alias("row_pos"),
            F.array(*[F.lit(str(v)) for v in cells]).alias("vals"), F.array(*[F.lit(not isinstance(v, str)) for v in cells]).alias("nums"))
    parts = [
        lit_rows("book_a.xlsx", "Nations", 0, [["Nation list"], ["source: nation"],
                                                ["n_nationkey", "n_name", "n_regionkey"]]),
        lit_rows("book_a.xlsx", "Regions", 1, [["r_regionkey", "r_name"]]),
        heads("Customers", 0, ["Airline PNR", "Airline Code", "Sector", "Customer"]),
        heads("Numbers", 1, [2024, "c_custkey", "segment"]),
        data_rows(nation, "book_a.xlsx", "Nations", 0,
                  [F.col("n_nationkey"), F.col("n_name"), F.col("n_regionkey")], [True, False, True]),
        data_rows(region, "book_a.xlsx", "Regions", 1, [F.col("r_regionkey"), F.col("r_name")], [True, False]),
        data_rows(cust, book_b, "Customers", 0,
                  [F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment"), F.col("c_name")],
                  [True, True, False, False]),
        data_rows(cust, book_b, "Numbers", 1,
                  [F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")], [True, True, False]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _open_output(uri: str):
    from pyarrow import fs as pafs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    filesystem, path = pafs.FileSystem.from_uri(uri)
    return filesystem.open_output_stream(path)


def build_x5(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write the X5 workbooks under ``root``/books. A workbook is put together
    by the task that has its rows (a zip needs the whole file; its rows are
    bounded) and written to the shared folder from there."""
    import pandas as pd

    from .sources.files import hadoop_mkdirs
    from .sources.workbook import xlsx_bytes

    folder = f"{root}/books"
    hadoop_mkdirs(spark, folder)
    layout = dict(X5_SHEETS)

    def cell(v, number):
        if v is None or not number:
            return v
        return int(v) if float(v).is_integer() else float(v)

    def write(pdf):
        book = pdf["book"].iloc[0]
        pdf = pdf.sort_values(["sheet_pos", "row_pos"])
        sheets = {name: [[cell(v, n) for v, n in zip(vals, nums)] for vals, nums in zip(part["vals"], part["nums"])]
                  for name, part in pdf.groupby("sheet")}
        data = xlsx_bytes([(s, sheets.get(s, [])) for s in layout[book[:6]]])
        with _open_output(f"{folder}/{book}") as fh:
            fh.write(data)
        return pd.DataFrame({"book": [book], "size": [len(data)]})

    x5_rows(spark, sf_dir).groupBy("book").applyInPandas(write, "book string, size bigint").write.format("noop").mode(
        "overwrite").save()
    return folder


def x5_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a non-negative balance: the others stay unmatched."""
    return table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("PNR_Number"), F.col("c_nationkey").alias("Airline_Code"),
        F.col("c_mktsegment").alias("Travel_Sector"), F.col("c_acctbal").alias("Taxable_Amount"))


# X7 ------------------------------------------------------------------------
# Odd CSV files from `orders`, one per status and key range: 'clash' has a
# white-space-only first line, a line break in a header and in each row, labels
# that differ in case only and labels the job uses for its own columns; 'flat'
# has white-space-only lines between its rows and quotes inside plain cells.
# Three kinds cannot be read: 'ragged' has one row with more cells than its
# header, 'stray' one whose cells hold quotes that open nothing and which has
# more cells than the header for that, 'open' a quoted cell that never ends.

X7_CLASH = ["Airline PNR", "Airline Code", "Sector", "sheet", "Sheet", "run_id", "output", "source_file", '"Line\nBreak"', "Amount", "amount"]


def build_x7(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write the X7 folder under ``root``; returns it."""
    from .sources.files import hadoop_glob, hadoop_mkdirs, hadoop_rename

    o = table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    prio, price = F.col("o_orderpriority"), F.col("o_totalprice").cast("string")
    line = lambda *cells: F.concat_ws(",", *cells)
    clash = line(key, cust, prio, F.concat(F.lit("s"), key), F.lit("S"), F.lit("r"), F.lit("o"), F.lit("f"),
                 F.concat(F.lit('"a\n'), key, F.lit('"')), price, F.lit("-1"))
    head = "Airline PNR,Airline Code,Sector,Amount"
    plain = line(key, cust, prio, price)
    flat = F.when(F.col("o_orderkey") % 8 == 1, F.concat(line(key, cust, prio, F.concat(price, F.lit('"'))), F.lit("\n \t"))).otherwise(plain)
    of = F.col("o_orderkey") % 3
    status = F.col("o_orderstatus")
    kinds = [(status == "F", "clash", "   \n" + ",".join(X7_CLASH), clash), (status == "O", "flat", head, flat),
             ((status == "P") & (of == 0), "ragged", head + "\n1,2,3,4,5", plain),
             ((status == "P") & (of == 1), "stray", head + '\n1,2,5" pipe,4,6" x', plain),
             ((status == "P") & (of == 2), "open", head + '\n1,2,B,"open', plain)]
    kind = top = value = F.lit(None).cast("string")
    for mine, name, header, cells in kinds:
        kind, top, value = F.when(mine, F.lit(name)).otherwise(kind), F.when(mine, F.lit(header)).otherwise(top), F.when(mine, cells).otherwise(value)
    name = F.format_string("%s_%d", kind, F.floor(F.col("o_orderkey") / X3_KEYS_PER_FILE).cast("bigint"))
    rows = o.select(name.alias("name"), F.col("o_orderkey").cast("bigint").alias("seq"), value.alias("value"))
    tops = o.select(name.alias("name"), F.lit(-1).cast("bigint").alias("seq"), top.alias("value")).distinct()
    staging, feeds = f"{root}/staging", f"{root}/feeds"
    (rows.unionByName(tops).repartition("name").sortWithinPartitions("name", "seq").select("name", "value")
     .write.partitionBy("name").text(staging))
    hadoop_mkdirs(spark, feeds)
    for part in hadoop_glob(spark, f"{staging}/name=*/part-*"):
        hadoop_rename(spark, part, f"{feeds}/{part.split('/')[-2].split('=', 1)[1]}.csv")
    return feeds
