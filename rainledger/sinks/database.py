"""Tables of a database as targets: all of the new rows or all of the old."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

SIDE = "__load"
#: What encloses statements that take effect together, sent as one statement; the first form is standard SQL.
_ATOMIC = {
    "": "BEGIN ATOMIC {} END",
    "postgresql": "DO $$ BEGIN {} END $$",
    "oracle": "BEGIN {} COMMIT; END;",
    "sqlserver": "SET XACT_ABORT ON; BEGIN TRANSACTION; {} COMMIT TRANSACTION;",
}
_BRACKETS = {"mysql": "``", "mariadb": "``", "sqlserver": "[]"}


def _database(url: str) -> str:
    return url.split(":")[1] if url.startswith("jdbc:") else ""


def side_options(url: str, table: str, options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of the write that fills the side table; its rows of an earlier load are replaced."""
    return {"url": url, "dbtable": table + SIDE, **(options or {})}


def switching_statement(url: str, table: str, columns: Sequence[str]) -> str:
    """One statement that replaces a table's rows by those of its side table; repeating it changes nothing.

    The table keeps its declared columns, keys and grants, and whoever reads meanwhile sees the old rows. A value that
    its declaration refuses (a text too long, a key twice) undoes the whole statement.
    """
    database = _database(url)
    if database in ("mysql", "mariadb"):
        raise ValueError(f"{database} runs no block of statements: give one as ``switch``, such as a call of a procedure")
    first, last = _BRACKETS.get(database, '""')
    names = ", ".join(f"{first}{column}{last}" for column in columns)
    body = f"DELETE FROM {table}; INSERT INTO {table} ({names}) SELECT {names} FROM {table}{SIDE};"
    return _ATOMIC.get(database, _ATOMIC[""]).format(body)


def switch_options(url: str, table: str, statement: str, options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of the read of one row that runs the statement on its own connection, then counts the table."""
    query = f"SELECT COUNT(*) AS row_count FROM {table}"
    return {"url": url, "query": query, "sessionInitStatement": statement, **(options or {})}


def write_jdbc(
    df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None, switch: str | None = None
) -> int:
    """Replace a database table's rows, and return how many it has then.

    Tasks fill a side table over many connections. Only when it is complete, one statement on one connection moves its
    rows into the table, so a load that fails leaves the table as it was. ``switch`` replaces that statement; it should be
    one that may be repeated, since a lost executor's task is.
    """
    statement = switch or switching_statement(url, table, df.columns)
    df.write.format("jdbc").options(**side_options(url, table, options)).mode("overwrite").save()
    read = df.sparkSession.read.format("jdbc").options(**switch_options(url, table, statement, options))
    return read.load().first()["row_count"]
