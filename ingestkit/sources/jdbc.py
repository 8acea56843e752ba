"""JDBC sources (S1-S4): URL per dialect, reads in ranges or in parts of equal size, pushed-down increments."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ..spec import ResolvedTable
from .files import incremental_filter

# URL templates and default ports per dialect.
URL_TEMPLATES = {
    "postgresql": ("jdbc:postgresql://{host}:{port}/{database}", 5432),
    "mysql": ("jdbc:mysql://{host}:{port}/{database}", 3306),
    "mariadb": ("jdbc:mariadb://{host}:{port}/{database}", 3306),
    "sqlserver": ("jdbc:sqlserver://{host}:{port};databaseName={database}", 1433),
    "oracle": ("jdbc:oracle:thin:@//{host}:{port}/{database}", 1521),
    "derby": ("jdbc:derby:{database}", None),
}


SPREAD = 1_000_003
#: Table options of a read in equally large parts.
SPLIT_OPTIONS = ("splitColumn", "splitParts", "splitTie")


def jdbc_url(driver_type: str = "postgresql", host: str = "localhost", port: int | None = None, database: str = "") -> str:
    """S4."""
    if driver_type not in URL_TEMPLATES:
        raise ValueError(f"unsupported JDBC dialect {driver_type!r}")
    template, default_port = URL_TEMPLATES[driver_type]
    return template.format(host=host, port=port or default_port, database=database)


def jdbc_options(
    connection: dict,
    credentials: dict | None = None,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    extra: dict | None = None,
) -> dict[str, str]:
    """Reader options; a partition column splits the read into parallel range queries."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    url = connection.get("url") or jdbc_url(
        connection.get("driver_type", "postgresql"), connection.get("host", "localhost"), connection.get("port"), connection.get("database", "")
    )
    opts = {"url": url, "fetchsize": str(fetch_size)}
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    if connection.get("driver"):
        opts["driver"] = connection["driver"]
    creds = credentials or {}
    if "username" in creds or "user" in creds:
        opts["user"] = creds.get("username", creds.get("user"))
    if "password" in creds:
        opts["password"] = creds["password"]
    if partition_column:
        if table is None:
            raise ValueError("partitioned reads need dbtable, not query")
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column, lowerBound=str(lower_bound), upperBound=str(upper_bound), numPartitions=str(num_partitions)
        )
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def _literal(value) -> str:
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal)):
        return "'" + str(value).replace("'", "''") + "'"
    return str(value)


def depth_query(table: str, column: str, parts: int) -> str:
    """Ends of ``parts`` parts of ``table`` that hold as many rows each, in the order of ``column``."""
    ranked = f"SELECT {column} AS c, ntile({int(parts)}) OVER (ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL"
    return f"SELECT max(c) AS c FROM ({ranked}) q GROUP BY part ORDER BY part"


def depth_predicates(column: str, ends: list, tie: str | None = None) -> list[str]:
    """WHERE clauses that together give every row once, from the ends of equally large parts.

    Ranges of equal width, which bounds and a number of partitions ask for, leave a skewed column to few tasks;
    ranges between these ends hold as many rows each. A value that fills several parts by itself ends all of
    them; with ``tie``, a whole-number column (best a unique one), its rows are dealt out by remainder, else they
    are one part. Nulls come with the first part, values above the last end (rows newer than the ends) with
    the last.
    """
    times = Counter(ends)
    cuts = list(dict.fromkeys(ends))
    if not cuts:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    out, low = [], None
    for i, cut in enumerate(cuts):
        over = f"{column} > {_literal(low)}" if low is not None else None
        hot = times[cut] - (1 if i == 0 or times[cut] == 1 else 0)
        if times[cut] > 1:
            out.append(" AND ".join(x for x in (over, f"{column} < {_literal(cut)}") if x))
            if tie:
                # spread before the remainder is taken: the rows of one value may be every third of the table
                spread = f"mod(mod(mod({tie}, {SPREAD}) + {SPREAD}, {SPREAD}) * 7919, {SPREAD})"
                rest = [f"mod({spread}, {hot}) = {r}" for r in range(hot)]
                out += [f"{column} = {_literal(cut)} AND {x}" for x in rest]
                out.append(f"{column} = {_literal(cut)} AND {tie} IS NULL")
            else:
                out.append(f"{column} = {_literal(cut)}")
        else:
            out.append(" AND ".join(x for x in (over, f"{column} <= {_literal(cut)}") if x))
        low = cut
    out[0] = f"({out[0]}) OR {column} IS NULL"
    return [*out, f"{column} > {_literal(low)}"]


def read_jdbc(spark: SparkSession, table: ResolvedTable, watermark=None, **partitioning) -> DataFrame:
    """Full or incremental read. The increment is a DataFrame filter that
    Spark's JDBC source pushes into the remote WHERE clause. With the table options ``splitColumn``,
    ``splitParts`` and perhaps ``splitTie`` the database is asked for the ends of equally large parts (as many
    rows as parts reach the driver), and each part is read by a task of its own."""
    spec = table.table
    split = {k: spec.options[k] for k in SPLIT_OPTIONS if k in spec.options}
    if split:
        plain = {k: v for k, v in spec.options.items() if k not in SPLIT_OPTIONS}
        opts = jdbc_options(table.source.connection, table.source.credentials, table=spec.source_table, extra=plain)
        asked = {k: v for k, v in opts.items() if k != "dbtable"} | {
            "query": depth_query(spec.source_table, split["splitColumn"], int(split.get("splitParts", 8)))
        }
        ends = [r[0] for r in spark.read.format("jdbc").options(**asked).load().collect()]
        where = depth_predicates(split["splitColumn"], ends, split.get("splitTie"))
        properties = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
        df = spark.read.jdbc(opts["url"], spec.source_table, predicates=where, properties=properties)
        if spec.load_type == "incremental" and spec.incremental_column:
            df = incremental_filter(df, spec.incremental_column, watermark, spec.watermark_seconds)
        return df
    query = spec.options.get("query")
    opts = jdbc_options(
        table.source.connection, table.source.credentials, table=None if query else spec.source_table, query=query,
        extra=spec.options, **partitioning,
    )
    df = spark.read.format("jdbc").options(**opts).load()
    if spec.load_type == "incremental" and spec.incremental_column:
        df = incremental_filter(df, spec.incremental_column, watermark, spec.watermark_seconds)
    return df
