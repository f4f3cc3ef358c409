"""Sources, sinks and upserts as queries: what is written is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import inputs as i
from millrace.catalog.layers import FIRST, LAST
from millrace.catalog.registry import query
from millrace.functions.calendar import run_date
from millrace.operators.merge import replace_date, row_hash, upsert
from millrace.plans.gold import hours_of
from millrace.session import scratch_path
from millrace.sources.documents import flatten_equipment, json_documents
from millrace.sources.key_index import KeyIndex
from millrace.sources.plain import (
    append_parquet,
    dry_run,
    overwrite_parquet,
    overwrite_partitions,
    read_parquet,
)
from millrace.sources.relational import FrameRelations
from millrace.sources.tables import SnapshotTable


def _tables(spark, d) -> FrameRelations:
    return FrameRelations(lambda name: i.table(spark, d, name))


# -- sources ----------------------------------------------------------------


@query("src01", "SELECT * FROM supplier")
def src01(spark, d):
    return _tables(spark, d).table("supplier")


@query(
    "src02",
    f"SELECT * FROM lineitem WHERE cast(l_shipdate AS date) BETWEEN DATE '{FIRST}' AND DATE '{LAST}'",
)
def src02(spark, d):
    return _tables(spark, d).window("lineitem", "l_shipdate", FIRST, LAST)


_CHILDREN_SQL = f"""
SELECT l.* FROM lineitem l INNER JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE cast(o.o_orderdate AS date) BETWEEN DATE '2001-07-01' AND DATE '{LAST}'"""


def _children(spark, d):
    return _tables(spark, d).children_of_window(
        "lineitem", "l_orderkey", "orders", "o_orderkey", "o_orderdate",
        run_date("2001-07-01"), LAST,
    )


query("src03", _CHILDREN_SQL)(_children)
query("join04", _CHILDREN_SQL)(_children)


@query("src04", i.SQL_DOCUMENTS)
def src04(spark, d):
    """Documents from a JSON export, read with a declared schema."""
    path = scratch_path(spark, "documents")
    i.documents(spark, d).write.json(path)
    flat = flatten_equipment(json_documents(spark, path))
    return flat.select(
        *[c for c in flat.columns if c not in ("sensors", "instalado_em")],
        i.ntz("instalado_em").alias("instalado_em"),
        F.size("sensors").alias("n_sensors"),
    )


@query("src05", "SELECT * FROM orders")
def src05(spark, d):
    path = scratch_path(spark, "bronze-orders")
    append_parquet(i.table(spark, d, "orders"), path)
    return read_parquet(spark, path)


@query("src08", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def src08(spark, d):
    """A table read with a partition value: other folders are not listed."""
    table = _stored(spark, i.table(spark, d, "orders"), "orders", ["o_orderstatus"])
    return table.read({"o_orderstatus": "F"})


def _stored(spark, df, name, partition_by=()) -> SnapshotTable:
    table = SnapshotTable(spark, scratch_path(spark, name))
    table.replace(table.stage(df, partition_by))
    return table


@query(
    "src10",
    """SELECT cast(strftime(data, '%Y%m%d') AS bigint) * 100 + hora AS date_key, data,
       cast(hora AS integer) AS hora
       FROM (SELECT DISTINCT cast(ts AS date) AS data FROM events), range(24) h(hora)""",
)
def src10(spark, d):
    """24 generated rows for every day that has events."""
    days = i.table(spark, d, "events").select(F.to_date("ts").alias("data")).distinct()
    return hours_of(days).select("date_key", "data", "hora")


@query(
    "src11",
    f"""SELECT t.id, t.nome, t.unidade, count(n) AS eventos FROM ({i.SQL_TYPES}) t
        LEFT JOIN ({i.SQL_EVENTS}) e ON e.measurement_type = t.nome GROUP BY ALL""",
)
def src11(spark, d):
    """Inline rows as a table, with the number of events of each."""
    counts = (
        i.events(spark, d).groupBy(F.col("measurement_type").alias("nome"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    joined = i.types(spark).join(counts, "nome", "left")
    return joined.select("id", "nome", "unidade", F.coalesce("n", F.lit(0)).alias("eventos"))


@query("src12", "SELECT FALSE AS antes, TRUE AS depois, count(*) AS linhas FROM orders")
def src12(spark, d):
    """Whether a table exists, before and after its first load."""
    table = SnapshotTable(spark, scratch_path(spark, "probe"))
    before = table.exists()
    table.replace(table.stage(i.table(spark, d, "orders").select("o_orderkey")))
    return table.read().agg(
        F.lit(before).alias("antes"),
        F.lit(table.exists()).alias("depois"),
        F.count(F.lit(1)).alias("linhas"),
    )


# -- plain sinks ------------------------------------------------------------


@query(
    "snk01",
    """SELECT *, DATE '2024-01-01' AS _execution_date FROM orders
       UNION ALL SELECT *, DATE '2024-01-02' FROM orders""",
)
def snk01(spark, d):
    """Two run dates appended; the second is loaded twice and stays single."""
    table = SnapshotTable(spark, scratch_path(spark, "appended"))
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        batch = i.table(spark, d, "orders").withColumn("_execution_date", F.lit(run_date(day)))
        staged = table.stage(batch, ["_execution_date"])
        table.replace_partitions(staged, {"_execution_date": day})
    return table.read()


@query("snk02", "SELECT * FROM part")
def snk02(spark, d):
    """First load of a partitioned table."""
    return _stored(spark, i.table(spark, d, "part"), "part", ["p_type"]).read()


@query(
    "snk08",
    f"SELECT count(*) AS linhas, cast(sum(strlen(equipment_id)) AS bigint) AS bytes FROM ({i.SQL_EVENTS})",
)
def snk08(spark, d):
    """Dry run: rows and key bytes of all messages, nothing written."""
    size = F.coalesce(F.sum(F.octet_length("key")), F.lit(0)).alias("bytes")
    counted = dry_run(i.messages(spark, d), size)
    return spark.createDataFrame(
        [(counted["rows"], counted["bytes"])], "linhas long, bytes long"
    )


@query("snk09", "SELECT * FROM customer")
def snk09(spark, d):
    """Overwritten twice, read back once."""
    path = scratch_path(spark, "overwritten")
    for _ in range(2):
        overwrite_parquet(i.table(spark, d, "customer"), path)
    return read_parquet(spark, path)


@query(
    "snk10",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END
       AS o_totalprice, o_orderstatus FROM orders""",
)
def snk10(spark, d):
    """Only the partitions in the second write are replaced."""
    path = scratch_path(spark, "dynamic")
    o = i.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    overwrite_partitions(o, path, ["o_orderstatus"])
    doubled = o.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    overwrite_partitions(doubled, path, ["o_orderstatus"])
    return read_parquet(spark, path)


# -- upserts ----------------------------------------------------------------
# Target: the latest line item of each (order, line). Source: every order as
# a correction of its line 1, dated 60 days after the order. Some lines have
# no correction, some corrections no line, some corrections are too old.


def _target(spark, d):
    li = i.table(spark, d, "lineitem")
    return li.groupBy(
        F.col("l_orderkey").alias("pedido"), F.col("l_linenumber").alias("linha")
    ).agg(
        F.max("l_extendedprice").alias("valor"),
        F.max("l_linestatus").alias("estado"),
        F.max(F.to_date("l_shipdate")).alias("_execution_date"),
    )


def _source(spark, d):
    o = i.table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("pedido"),
        F.lit(1).alias("linha"),
        F.col("o_totalprice").alias("valor"),
        F.col("o_orderstatus").alias("estado"),
        F.date_add("o_orderdate", 60).alias("_execution_date"),
    )


_TARGET_SQL = """
SELECT l_orderkey AS pedido, l_linenumber AS linha, max(l_extendedprice) AS valor,
       max(l_linestatus) AS estado, cast(max(l_shipdate) AS date) AS _execution_date
FROM lineitem GROUP BY ALL"""
_SOURCE_SQL = """
SELECT o_orderkey AS pedido, cast(1 AS integer) AS linha, o_totalprice AS valor,
       o_orderstatus AS estado, cast(o_orderdate + INTERVAL 60 DAY AS date) AS _execution_date
FROM orders"""


def _upsert_sql(target: str, source: str, guard: str, columns: str, keys: str) -> str:
    chosen = ", ".join(
        f"CASE WHEN take THEN s_{c} ELSE t_{c} END AS {c}" for c in columns.split()
    )
    t = ", ".join(f"t.{c} AS t_{c}" for c in columns.split())
    s = ", ".join(f"s.{c} AS s_{c}" for c in columns.split())
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys.split())
    first = keys.split()[0]
    return f"""
SELECT {chosen} FROM (
  SELECT {t}, {s}, t.{first} IS NULL OR (s.{first} IS NOT NULL AND {guard}) AS take
  FROM ({target}) t FULL JOIN ({source}) s ON {on})"""


_COLUMNS = "pedido linha valor estado _execution_date"
_NEWER = "s._execution_date >= t._execution_date"
_UPSERT_SQL = _upsert_sql(_TARGET_SQL, _SOURCE_SQL, _NEWER, _COLUMNS, "pedido linha")


@query("snk03", _UPSERT_SQL)
def snk03(spark, d):
    return upsert(_target(spark, d), _source(spark, d), ["pedido", "linha"])


@query("join05", _UPSERT_SQL)
def join05(spark, d):
    """The same upsert into a stored, partitioned table."""
    table = _stored(spark, _target(spark, d), "lines", ["estado"])
    table.merge(table.stage(_source(spark, d), ["estado"]), ["pedido", "linha"])
    return table.read()


@query("join05_index", _UPSERT_SQL)
def join05_index(spark, d):
    """The upsert with an index of the keys; the target comes in two loads, by half of the orders."""
    keys, target = ["pedido", "linha"], _target(spark, d)
    table = SnapshotTable(spark, scratch_path(spark, "indexed-lines"))
    index = KeyIndex(table, keys)
    odd = F.col("pedido") % 2 == 1
    for batch in (target.filter(odd), target.filter(~odd), _source(spark, d)):
        table.merge(table.stage(batch, ["estado"]), keys, index=index)
    return table.read()


@query(
    "snk04",
    _upsert_sql(
        _TARGET_SQL, _SOURCE_SQL, f"{_NEWER} AND s.estado <> t.estado", _COLUMNS, "pedido linha"
    ),
)
def snk04(spark, d):
    """A correction must also differ in its hashed columns."""
    hashed = {"_row_hash": row_hash(["estado"])}
    merged = upsert(
        _target(spark, d).withColumns(hashed),
        _source(spark, d).withColumns(hashed),
        ["pedido", "linha"],
        use_row_hash=True,
    )
    return merged.drop("_row_hash")


RELOAD = "1998-09-01"
_DAY_TARGET_SQL = """
SELECT cast(l_shipdate AS date) AS _execution_date, l_suppkey AS fornecedor, count(*) AS itens
FROM lineitem GROUP BY ALL"""
_DAY_SOURCE_SQL = f"""
SELECT DATE '{RELOAD}' AS _execution_date, s_suppkey AS fornecedor, cast(-1 AS bigint) AS itens
FROM supplier WHERE s_acctbal > 0"""
_REPLACED_SQL = f"""
SELECT * FROM ({_DAY_TARGET_SQL}) WHERE _execution_date <> DATE '{RELOAD}'
UNION ALL {_DAY_SOURCE_SQL}"""


def _day_target(spark, d):
    li = i.table(spark, d, "lineitem")
    return li.groupBy(
        F.to_date("l_shipdate").alias("_execution_date"), F.col("l_suppkey").alias("fornecedor")
    ).agg(F.count(F.lit(1)).alias("itens"))


def _day_source(spark, d):
    s = i.table(spark, d, "supplier").filter("s_acctbal > 0")
    return s.select(
        F.lit(run_date(RELOAD)).alias("_execution_date"),
        F.col("s_suppkey").alias("fornecedor"),
        F.lit(-1).cast("long").alias("itens"),
    )


@query("snk05", _REPLACED_SQL)
def snk05(spark, d):
    """A run date is dropped from the table, then its new rows are merged."""
    return replace_date(
        _day_target(spark, d),
        _day_source(spark, d),
        ["_execution_date", "fornecedor"],
        run_date(RELOAD),
    )
