"""Logical schemas of the stored tables and change logs.

Timestamps are epoch milliseconds; the stored tables hold them as strings, the
operators work on ``bigint``.
"""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

TEXT, FLAG, WHOLE, REAL, DAY = StringType(), BooleanType(), LongType(), DoubleType(), DateType()
TEXT_SET = ArrayType(TEXT)


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


ARTICLE_RAW = _table(
    authors=TEXT, category=TEXT, date=TEXT, headline=TEXT, link=TEXT, short_description=TEXT
)

ARTICLE = _table(author=TEXT, category=TEXT, date=DAY, headline=TEXT, link=TEXT, description=TEXT)

USER = _table(
    username=TEXT,
    password=TEXT,
    firstname=TEXT,
    lastname=TEXT,
    email=TEXT,
    affiliation=TEXT,
    birthday=TEXT,
    interests=TEXT_SET,
    loggedin=FLAG,
    likednewsarticles=TEXT_SET,
    seenarticles=TEXT_SET,
)

USER_SEARCH = _table(fullname=TEXT, username=TEXT)

FRIEND = _table(username1=TEXT, timestamp=TEXT, username2=TEXT)

WALL_POST = _table(
    posterusername=TEXT, postuniqueid=TEXT, timestamp=TEXT, content=TEXT, wallusername=TEXT, flipped=FLAG
)

STATUS_POST = _table(posterusername=TEXT, postuniqueid=TEXT, timestamp=TEXT, content=TEXT)

COMMENT = _table(usernameofcommentor=TEXT, postuniqueid=TEXT, timestamp=TEXT, content=TEXT)

MEMBERSHIP = _table(roomuniqueid=WHOLE, member=TEXT, roomname=TEXT)

MESSAGE = _table(roomuniqueid=WHOLE, timestamp=TEXT, content=TEXT, sender=TEXT)

KEYWORD_INDEX = _table(keyword=TEXT, link=TEXT)

CATALOG = _table(
    link=TEXT, likes=WHOLE, headline=TEXT, date=TEXT, author=TEXT, description=TEXT, category=TEXT
)

SCORE = _table(
    username=TEXT,
    link=TEXT,
    author=TEXT,
    category=TEXT,
    date=TEXT,
    headline=TEXT,
    description=TEXT,
    weight=REAL,
)
