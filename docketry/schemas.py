"""Table schemas."""

from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()

CONTEXT = T.StructType(
    [
        T.StructField("tipo", S),
        T.StructField("busca", S),
        T.StructField("numero", S),
        T.StructField("cnpj", S),
        T.StructField("page_idx", I),
        T.StructField("endpoint", S),
        T.StructField("req_id", L),
    ]
)

RAW_PAGES = T.StructType(
    [
        T.StructField("page_id", L),
        T.StructField("url", S),
        T.StructField("method", S),
        T.StructField("status", I),
        T.StructField("headers", T.MapType(S, S)),
        T.StructField("html", S),
        T.StructField("payload", S),
        T.StructField("context", CONTEXT),
        T.StructField("fetched_at", S),
        T.StructField("hash_html", S),
    ]
)

PARTY = T.StructType([T.StructField("papel", S), T.StructField("nome", S)])
MOVEMENT = T.StructType([T.StructField("data", S), T.StructField("texto", S)])

PROCESSOS = T.StructType(
    [
        T.StructField("_id", S),
        T.StructField("numero_processo", S),
        T.StructField("numero_legado", S),
        T.StructField("data_autuacao", S),
        T.StructField("relator", S),
        T.StructField("envolvidos", T.ArrayType(PARTY)),
        T.StructField("movimentacoes", T.ArrayType(MOVEMENT)),
        T.StructField("fonte_url", S),
        T.StructField("scraped_at", S),
        T.StructField("reprocessed_at", S),
        T.StructField("reprocessed_from_doc", S),
    ]
)

CRAWL_REQUESTS = T.StructType(
    [
        T.StructField("req_id", L),
        T.StructField("modo", S),
        T.StructField("valor", S),
        T.StructField("max_pages", I),
        T.StructField("max_details_per_page", I),
    ]
)

FETCH_LOG = T.StructType(
    [
        T.StructField("host", S),
        T.StructField("seq", L),
        T.StructField("ts", T.TimestampType()),
        T.StructField("url", S),
        T.StructField("endpoint", S),
        T.StructField("status", I),
        T.StructField("html", S),
        T.StructField("exception", S),
        T.StructField("retry_times", I),
        T.StructField("download_timeout", T.DoubleType()),
    ]
)
