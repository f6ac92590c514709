"""The staged JDBC write, against a connection that only notes what it is told: there is no database here."""

import pytest
from conftest import rows

from tallyhouse.sinks import jdbc


class Connection:
    """Notes statements; the stage holds ``held`` rows, and the statement that starts with ``failing`` fails."""

    def __init__(self, held, failing=None):
        self.held, self.failing, self.said = held, failing, []

    def setAutoCommit(self, on):
        self.said.append(f"autocommit {on}")

    def createStatement(self):
        return self

    def executeQuery(self, text):
        self.said.append(text)
        return self

    def executeUpdate(self, text):
        if self.failing and text.startswith(self.failing):
            raise ValueError(text)
        self.said.append(text)

    def next(self):
        return True

    def getLong(self, _):
        return self.held

    def commit(self):
        self.said.append("commit")

    def rollback(self):
        self.said.append("rollback")

    def close(self):
        self.said.append("close")


INSERT = (
    'INSERT INTO fact ("id", "a""b") SELECT "id", "a""b" FROM '
    '(SELECT DISTINCT "id", "a""b", "stage_row" FROM fact_stage) t'
)


def test_rows_are_replaced_in_one_transaction():
    connection = Connection(3)
    jdbc.move_staged(connection, "fact", "fact_stage", ["id", 'a"b'], 3)
    assert connection.said == [
        "autocommit False",
        'SELECT COUNT(DISTINCT "stage_row") FROM fact_stage',
        "DELETE FROM fact",
        INSERT,
        "commit",
        "DROP TABLE fact_stage",
        "commit",
        "close",
    ]


def test_rows_of_a_key_are_replaced_and_null_keys_are_equal():
    remove, insert = jdbc.move_statements("fact", "fact_stage", ["id", 'a"b'], ["id"])
    assert insert == INSERT
    assert remove == (
        "DELETE FROM fact WHERE EXISTS (SELECT 1 FROM fact_stage s WHERE "
        '(s."id" = fact."id" OR (s."id" IS NULL AND fact."id" IS NULL)))'
    )


@pytest.mark.parametrize("failing", ["DELETE", "INSERT"])
def test_a_failed_statement_moves_nothing(failing):
    connection = Connection(3, failing)
    with pytest.raises(ValueError):
        jdbc.move_staged(connection, "fact", "fact_stage", ["id"], 3)
    assert connection.said[-2:] == ["rollback", "close"]
    assert "commit" not in connection.said


def test_a_stage_that_lacks_rows_moves_nothing():
    connection = Connection(2)
    with pytest.raises(RuntimeError, match="holds 2 rows instead of 3"):
        jdbc.move_staged(connection, "fact", "fact_stage", ["id"], 3)
    assert connection.said[2:] == ["rollback", "close"]


def test_rows_are_numbered_once_and_sent_from_the_shared_folder(spark, tmp_path):
    sent, connection = [], Connection(40)

    def write(df, url, table, props, mode, **sizes):
        # a task that runs again sends the same numbers
        sent.append((url, table, props, mode, sizes, rows(df), rows(df)))

    n = jdbc.write_jdbc_once(
        spark.range(40).repartition(5), "jdbc:x", "fact", {"user": "u"}, f"{tmp_path}/stage", ["id"],
        write, lambda *_: connection, connections=3,
    )
    (url, table, props, mode, sizes, first, again), = sent
    assert (url, table, mode, sizes) == ("jdbc:x", "fact_stage", "overwrite", {"connections": 3})
    assert props == {"user": "u", "truncate": "false"}
    assert n == len(first) == len({number for _, number in first}) == 40 and first == again
    assert connection.said[2].startswith("DELETE FROM fact WHERE EXISTS")


def test_an_empty_result_still_replaces(spark, tmp_path):
    connection = Connection(0)
    empty = spark.range(0)
    assert jdbc.write_jdbc_once(
        empty, "jdbc:x", "fact", {}, f"{tmp_path}/stage", None, lambda *a, **k: None, lambda *_: connection
    ) == 0
    assert "DELETE FROM fact" in connection.said and "commit" in connection.said
