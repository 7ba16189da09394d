"""Database sources and targets over JDBC.

Connection data comes from the caller (job configuration or environment); no
address or credential is kept here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

# Rows per fetch, rows per insert batch, query time limit in seconds.
FETCH_ROWS = 10_000
INSERT_ROWS = 1_000
QUERY_SECONDS = 1_800

# Default ports and driver classes of the supported databases.
DATABASES: dict[str, dict[str, str]] = {
    "oracle": {"driver": "oracle.jdbc.OracleDriver", "port": "1521"},
    "vertica": {"driver": "com.vertica.jdbc.Driver", "port": "5433"},
}


def connection_options(kind: str, host: dict[str, str]) -> dict[str, str]:
    """JDBC options of one configured host (``dsn``, or ``host``/``port``/``database``)."""
    if kind not in DATABASES:
        raise ValueError(f"unsupported source: {kind}")
    known = DATABASES[kind]
    if kind == "oracle":
        dsn = host.get("dsn") or (
            f"{host['host']}:{host.get('port', known['port'])}/{host['database']}"
        )
        url = f"jdbc:oracle:thin:@{dsn}"
    else:
        url = f"jdbc:vertica://{host['host']}:{host.get('port', known['port'])}/{host['database']}"
        if host.get("tlsmode"):
            url += f"?TLSmode={host['tlsmode']}"
    options = {"url": url, "driver": known["driver"]}
    options.update({k: host[k] for k in ("user", "password") if host.get(k)})
    return options


def read_options(
    connection: dict[str, str],
    query: str,
    split: tuple[str, str, str, int] | None = None,
) -> dict[str, str]:
    """Reader options; `split` = (column, lower, upper, partitions) for a parallel read.

    The query goes in as a derived table: the ``query`` option cannot be
    combined with a split. Filters and columns added later are still pushed to
    the database.
    """
    options = dict(connection)
    options.update(
        dbtable=f"({query}) extract_query",
        fetchsize=str(FETCH_ROWS),
        queryTimeout=str(QUERY_SECONDS),
        pushDownPredicate="true",
        pushDownAggregate="true",
        pushDownLimit="true",
    )
    if split:
        column, lower, upper, partitions = split
        options.update(
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def read_query(
    spark: SparkSession,
    connection: dict[str, str],
    query: str,
    split: tuple[str, str, str, int] | None = None,
) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(connection, query, split)).load()


def write_options(connection: dict[str, str], table: str) -> dict[str, str]:
    return {**connection, "dbtable": table, "batchsize": str(INSERT_ROWS)}


def append_rows(
    df: DataFrame,
    connection: dict[str, str],
    table: str,
    columns: list[Column | str] | None = None,
    max_connections: int = 16,
) -> None:
    """Insert into an existing table in batches over a bounded number of connections."""
    rows = df.select(*columns) if columns else df
    (
        rows.write.format("jdbc")
        .options(**write_options(connection, table))
        .option("numPartitions", max_connections)
        .mode("append")
        .save()
    )
