"""Raw triples derived from the driver's relational test tables.

The test tables hold no triples, so every query builds them with the same
rows that the oracle SQL's ``UNION ALL`` lists.  Each table is scanned once
and only for the columns it needs (column pruning reaches the Parquet scan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triplex.constants import NAMESPACE
from triplex.schema import TRIPLE_COLUMNS

# --- FIXED VALUES: URIs used by the adapter ---------------------------------
RDFS_LABEL = "<http://www.w3.org/2000/01/rdf-schema#label>"
RDF_TYPE_SHORT = "<http://www.w3.org/1999/02/rdf-syntax-ns#type>"
RDF_TYPE_W3C = "<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>"
XSD_INT = "<http://www.w3.org/2001/XMLSchema#int>"
FOREIGN_SUPPLIER = "<http://x.example.org/s/"

TABLES = ("nation", "customer", "orders", "part", "supplier", "events", "documents")

# Declared schemas of the tables read by the library: a declared schema
# skips the footer-reading inference job on every load.
TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _ns(*parts: Column | str) -> Column:
    """``<NAMESPACE + parts... + >`` with literal strings taken as-is."""
    cols = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat(F.lit("<" + NAMESPACE), *cols, F.lit(">"))


def _quoted(c: Column, suffix: str | Column = "") -> Column:
    tail = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.concat(F.lit('"'), c, F.lit('"'), tail)


def _triples(df: DataFrame, *rows: tuple[Column, Column | str, Column]) -> DataFrame:
    """Emit one triple per ``(s, p, o)`` in ``rows`` for every row of ``df``.

    A table that yields several triples is scanned once: the triples of a
    row are built as an array of structs and exploded.
    """

    def lit(p):
        return F.lit(p) if isinstance(p, str) else p

    if len(rows) == 1:
        s, p, o = rows[0]
        return df.select(s.alias("Subject"), lit(p).alias("Predicate"), o.alias("Object"))
    structs = [
        F.struct(s.alias("Subject"), lit(p).alias("Predicate"), o.alias("Object")) for s, p, o in rows
    ]
    return df.select(F.explode(F.array(*structs)).alias("_t")).select("_t.*")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; declared schema when known, else inferred."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of all adapter branches: ``Subject, Predicate, Object`` strings."""
    t = {name: load_table(spark, sf_dir, name) for name in TABLES}
    nation, customer, orders, part = t["nation"], t["customer"], t["orders"], t["part"]
    supplier, events, documents = t["supplier"], t["events"], t["documents"]

    type_obj = _ns("business.", F.lower(F.col("p_type")))
    cust = _ns("m.c", _s("c_custkey"))
    prt = _ns("m.p", _s("p_partkey"))
    branches = [
        _triples(nation, (_ns("m.n", _s("n_nationkey")), RDFS_LABEL, _quoted(F.col("n_name"), "@en"))),
        _triples(
            customer,
            (cust, _ns("people.person.name"), _quoted(F.col("c_name"), "@en")),
            (cust, _ns("people.person.nationality"), _ns("m.n", _s("c_nationkey"))),
            (cust, _ns("people.person"), _quoted(F.col("c_mktsegment"))),
        ),
        _triples(
            orders,
            (_ns("m.c", _s("o_custkey")), _ns("business.customer.orders"), _ns("m.o", _s("o_orderkey"))),
            (_ns("m.o", _s("o_orderkey")), _ns("business.order.status"), _quoted(F.col("o_orderstatus"))),
        ),
        _triples(
            part,
            (prt, _ns("common.topic.alias"), _quoted(F.col("p_name"), "@en")),
            (prt, RDF_TYPE_SHORT, type_obj),
            (prt, RDF_TYPE_W3C, type_obj),
            (prt, _ns("business.part.size"), _quoted(_s("p_size"), "^^" + XSD_INT)),
        ),
        _triples(supplier, (F.concat(F.lit(FOREIGN_SUPPLIER), _s("s_suppkey"), F.lit(">")),
                            _ns("business.supplier.name"), _quoted(F.col("s_name"), "@en"))),
        _triples(events, (_ns("m.u", _s("user_id")), _ns("event.user.", F.col("event_type")),
                          _quoted(F.concat(F.col("event_type"), F.lit(" of m.u"), _s("user_id")), "@en"))),
        _triples(documents, (_ns("m.d", _s("doc_id")), _ns("common.topic.description"),
                             _quoted(F.col("text"), F.concat(F.lit("@"), F.col("lang"))))),
    ]
    out = branches[0]
    for b in branches[1:]:
        out = out.unionByName(b)
    return out.select(*TRIPLE_COLUMNS)


# --- the same adapter as DuckDB SQL, for the oracle -------------------------


def _sql_ns(*parts: str) -> str:
    return " || ".join([f"'<{NAMESPACE}'", *parts, "'>'"])


def _v(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


RAW_TRIPLES_SQL = f"""
SELECT {_sql_ns("'m.n'", _v("n_nationkey"))} AS Subject, '{RDFS_LABEL}' AS Predicate,
       '"' || n_name || '"@en' AS Object FROM nation
UNION ALL SELECT {_sql_ns("'m.c'", _v("c_custkey"))}, {_sql_ns("'people.person.name'")},
       '"' || c_name || '"@en' FROM customer
UNION ALL SELECT {_sql_ns("'m.c'", _v("c_custkey"))}, {_sql_ns("'people.person.nationality'")},
       {_sql_ns("'m.n'", _v("c_nationkey"))} FROM customer
UNION ALL SELECT {_sql_ns("'m.c'", _v("c_custkey"))}, {_sql_ns("'people.person'")},
       '"' || c_mktsegment || '"' FROM customer
UNION ALL SELECT {_sql_ns("'m.c'", _v("o_custkey"))}, {_sql_ns("'business.customer.orders'")},
       {_sql_ns("'m.o'", _v("o_orderkey"))} FROM orders
UNION ALL SELECT {_sql_ns("'m.o'", _v("o_orderkey"))}, {_sql_ns("'business.order.status'")},
       '"' || o_orderstatus || '"' FROM orders
UNION ALL SELECT {_sql_ns("'m.p'", _v("p_partkey"))}, {_sql_ns("'common.topic.alias'")},
       '"' || p_name || '"@en' FROM part
UNION ALL SELECT {_sql_ns("'m.p'", _v("p_partkey"))}, '{RDF_TYPE_SHORT}',
       {_sql_ns("'business.'", "lower(p_type)")} FROM part
UNION ALL SELECT {_sql_ns("'m.p'", _v("p_partkey"))}, '{RDF_TYPE_W3C}',
       {_sql_ns("'business.'", "lower(p_type)")} FROM part
UNION ALL SELECT {_sql_ns("'m.p'", _v("p_partkey"))}, {_sql_ns("'business.part.size'")},
       '"' || {_v("p_size")} || '"^^{XSD_INT}' FROM part
UNION ALL SELECT '{FOREIGN_SUPPLIER}' || {_v("s_suppkey")} || '>', {_sql_ns("'business.supplier.name'")},
       '"' || s_name || '"@en' FROM supplier
UNION ALL SELECT {_sql_ns("'m.u'", _v("user_id"))}, {_sql_ns("'event.user.'", "event_type")},
       '"' || event_type || ' of m.u' || {_v("user_id")} || '"@en' FROM events
UNION ALL SELECT {_sql_ns("'m.d'", _v("doc_id"))}, {_sql_ns("'common.topic.description'")},
       '"' || text || '"@' || lang FROM documents
"""
