"""Record contracts: wire schemas (as received) and target schemas (as stored)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, B = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()
DAY, TS = T.DateType(), T.TimestampType()
PRICE, MACRO = T.DecimalType(12, 4), T.DecimalType(18, 6)


def _struct(required: tuple[str, ...] = (), **fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in fields.items()])


NEWS_WIRE = _struct(
    source_name=S, title=S, description=S, url=S, published_at=S,
    content=S, search_query=S, category=S, fetched_at=S,
)
FILING_WIRE = _struct(
    ticker=S, company_name=S, cik=S, form_type=S, filed_at=S, period=S,
    accession_number=S, document_url=S, is_material_event=B,
    full_text=S, text_chars=L, fetched_at=S,
)
MARKET_WIRE = _struct(series_code=S, series_name=S, date=S, value=D, fetched_at=S)
PRICE_WIRE = _struct(
    ticker=S, date=S, open=D, high=D, low=D, close=D, volume=L, vwap=D, fetched_at=S,
)

MARKET_TABLE = _struct(
    ("series_code", "date"),
    series_code=S, series_name=S, date=DAY, value=MACRO, fetched_at=TS,
)
FILING_TABLE = _struct(
    ticker=S, company_name=S, cik=S, form_type=S, filed_at=DAY, period=DAY,
    accession_number=S, document_url=S, is_material_event=B, fetched_at=TS,
)
NEWS_TABLE = _struct(
    url=S, title=S, source_name=S, published_at=TS, date_only=DAY, category=S, fetched_at=TS,
)
PRICE_TABLE = _struct(
    ("ticker", "date"),
    ticker=S, date=DAY, open=PRICE, high=PRICE, low=PRICE, close=PRICE,
    volume=L, vwap=PRICE, fetched_at=TS,
)

NATURAL_KEY = {
    "news": ("url",),
    "filings": ("accession_number",),
    "market": ("series_code", "date"),
    "prices": ("ticker", "date"),
}

# Nested payloads the feeds arrive in.
ARTICLES_PAYLOAD = T.StructType([
    T.StructField("articles", T.ArrayType(T.StructType([
        T.StructField("source", T.StructType([T.StructField("name", S)])),
        T.StructField("title", S),
        T.StructField("description", S),
        T.StructField("url", S),
        T.StructField("publishedAt", S),
        T.StructField("content", S),
    ]))),
])
FILING_ARRAYS = T.StructType([
    T.StructField(n, T.ArrayType(S))
    for n in ("form", "filingDate", "accessionNumber", "primaryDocument", "reportDate")
])
FILING_PAYLOAD = T.StructType([
    T.StructField("name", S),
    T.StructField("filings", T.StructType([
        T.StructField("recent", FILING_ARRAYS),
        T.StructField("files", T.ArrayType(T.StructType([T.StructField("name", S)]))),
    ])),
])
OBSERVATIONS_PAYLOAD = T.StructType([
    T.StructField("observations", T.ArrayType(T.StructType([
        T.StructField("date", S), T.StructField("value", S),
    ]))),
])
BARS_PAYLOAD = T.StructType([
    T.StructField("bars", T.MapType(S, T.ArrayType(T.StructType([
        T.StructField("t", S), T.StructField("o", D), T.StructField("h", D),
        T.StructField("l", D), T.StructField("c", D), T.StructField("v", L),
        T.StructField("vw", D),
    ])))),
])
COMPANY_DICTIONARY = T.MapType(
    S, T.StructType([T.StructField("cik_str", L), T.StructField("ticker", S)])
)
