"""Order-insensitive comparison of a DataFrame with the rows of a SQL statement."""

from __future__ import annotations

from decimal import Decimal


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, Decimal)):
        number = Decimal(str(value))
        return format(number.normalize(), "f") if number else "0"
    return str(value)


def rows_of(records, columns, names):
    order = [names.index(c) for c in columns]
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=str)


def assert_same(df, con, sql):
    columns = sorted(df.columns)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = rows_of(cursor.fetchall(), columns, names)
    assert rows_of(df.collect(), columns, df.columns) == expected
