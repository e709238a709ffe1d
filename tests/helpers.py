from datetime import date, datetime


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def day(text: str) -> date:
    return date.fromisoformat(text)


def null_safe(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=null_safe)


def same(df, expected, ddl):
    """Values and schema: names, order and types."""
    want = df.sparkSession.createDataFrame([], ddl).schema
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    assert have == [(f.name, f.dataType.simpleString()) for f in want.fields]
    assert rows(df) == sorted([tuple(r) for r in expected], key=null_safe)
