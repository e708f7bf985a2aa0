"""DuckDB SQL giving the expected rows of the catalog from the base tables.

Expected values are computed from the tables the pages were rendered from, not
with the extraction rules.
"""

from __future__ import annotations

from docketry import constants as C
from docketry.sources.rendered import FILLER, PLAIN_SITE, ROUTE, SECOND, SITE


def _npu(k: str, year: str) -> str:
    return (
        f"lpad((({k}) % 10000000)::VARCHAR, 7, '0') || '-' || lpad((({k}) % 97)::VARCHAR, 2, '0') || '.' || "
        f"({year})::VARCHAR || '.4.05.' || lpad(((({k}) // 10000000) % 10000)::VARCHAR, 4, '0')"
    )


def _iso(k: str) -> str:
    return (
        f"strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(({k}) % 100000000), '%Y-%m-%dT%H:%M:%S')"
    )


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_CASES = f"""
o AS (
  SELECT o_orderkey AS k, c_name AS nm, CAST(o_orderdate AS DATE) AS d, o_orderstatus AS status,
         {_npu('o_orderkey', 'year(o_orderdate)')} AS npu, {_npu('o_orderkey + 1', 'year(o_orderdate)')} AS npu2,
         strftime(o_orderdate, '%d/%m/%Y') AS br
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

# last capture of every order, arrays as text
_RECORDS = f"""{_CASES},
rec AS (
  SELECT k, status, npu AS _id, npu AS numero_processo,
         CASE WHEN k % 3 <> 1 THEN '99.05.' || k || '-' || (k % 10) END AS numero_legado,
         CASE WHEN k % 11 = 0 THEN br WHEN k % 11 > 1 THEN CAST(d AS VARCHAR) END AS data_autuacao,
         CASE k % 13 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Juiz ' || nm || ' ' || (k % 3) ELSE nm END AS relator,
         '{SITE}/processo/' || npu AS fonte_url,
         {_iso('k * 4 + k % 3')} AS scraped_at,
         CASE WHEN k % 3 >= 1 THEN {_iso('k')} END AS reprocessed_at,
         CASE WHEN k % 3 >= 1 THEN k::VARCHAR END AS reprocessed_from_doc,
         array_to_string([(CASE WHEN j <> 3 THEN 'APTE=' ELSE '' END) || 'Parte ' || j for j in range(1, k % 4 + 1)], ';') AS envolvidos,
         CASE WHEN k % 17 <> 0 THEN array_to_string([(CASE WHEN i = 3 THEN br ELSE CAST(d + i::INTEGER AS VARCHAR) END)
              || '=Movimento ' || i for i in range(0, k % 5)], ';') END AS movimentacoes,
         k % 4 AS n_env, CASE WHEN k % 17 <> 0 THEN k % 5 ELSE 0 END AS n_mov,
         CASE WHEN k % 17 <> 0 AND k % 5 > 0 THEN CAST(d AS VARCHAR) END AS first_mov
  FROM o
)"""
_RECORD_COLUMNS = (
    "_id, numero_processo, numero_legado, data_autuacao, relator, fonte_url, scraped_at, "
    "reprocessed_at, reprocessed_from_doc, envolvidos, movimentacoes"
)

_MIXED = f"""{_RECORDS},
mixed0 AS (
  SELECT k AS page_id, k % 12 AS kind, '{SITE}/pagina/' || k AS url,
         '<html><body><p>{FILLER}</p>' AS a, '</body></html>' AS z, npu, npu2,
         CASE k % 5 WHEN 0 THEN 'lista' WHEN 1 THEN 'detalhe' WHEN 2 THEN 'outro' END AS tipo,
         CASE WHEN k % 2 = 0 THEN 'numero' ELSE 'cnpj' END AS busca,
         CASE WHEN k % 2 = 0 THEN CASE WHEN k % 9 = 0 THEN '123' ELSE npu END END AS numero,
         CASE WHEN k % 4 = 1 THEN k % 8 - 4 END AS page_idx,
         {_iso('k')} AS fetched_at
  FROM o
),
mixed AS (
  SELECT *, CASE kind
      WHEN 0 THEN a || '<p>' || npu || '</p><td>APTE</td>' || z
      WHEN 1 THEN '' WHEN 2 THEN '<html><body>oi</body></html>' WHEN 3 THEN '<body>{FILLER}</body>'
      WHEN 4 THEN a || 'Nenhum  resultado encontrado' || z
      WHEN 5 THEN a || 'O Número do Processo informado não é válido' || z
      WHEN 6 THEN a || 'Total: ' || (page_id % 90) || z
      WHEN 7 THEN a || '<a href="?page=2">Próxima</a>' || z
      WHEN 8 THEN a || '<table><tr><td>' || npu || '</td></tr><tr><td>' || npu2 || '</td></tr></table>' || z
      WHEN 9 THEN a || 'PROCESSO Nº 123 RELATOR X APTE Y 15/04/2000' || z
      WHEN 10 THEN a || 'nada' || z END AS html,
    CASE WHEN kind IN (0, 9) THEN 'detail' WHEN kind IN (6, 7, 8) THEN 'list' ELSE 'error' END AS page_class
  FROM mixed0
)"""

# expected content of the rendered detail pages
_FILED = "CASE WHEN k % 50 <> 49 THEN CAST(d AS VARCHAR) END"
_JUDGE_ONLINE = (
    "CASE k % 6 WHEN 3 THEN 'JUÍZA FEDERAL ' || nm WHEN 4 THEN 'A: ' || nm WHEN 5 THEN NULL ELSE nm END"
)
_JUDGE_OFFLINE = (
    "CASE k % 6 WHEN 1 THEN NULL WHEN 3 THEN 'JUÍZA FEDERAL ' || nm WHEN 4 THEN 'A: ' || nm WHEN 5 THEN NULL ELSE nm END"
)
_WHEN = "CAST(d + i::INTEGER AS VARCHAR) || 'T' || lpad((k % 24)::VARCHAR, 2, '0') || ':' || lpad((k % 60)::VARCHAR, 2, '0') || ':00'"
_MOVE_TEXT = "CASE WHEN k % 6 = 5 THEN 'Despacho ' || k || '-' || i ELSE 'Juntada de peça ' || (k * 10 + i) END"
_DETAIL = f"""{_CASES},
party0 AS (
  SELECT k, 0 AS grp, 0 AS j, 'RELATOR' AS papel, NULL AS online, ':' AS offline FROM o WHERE k % 6 = 0
  UNION ALL SELECT k, 0, 0, 'Relatora', 'JUÍZA FEDERAL ' || nm, 'JUÍZA FEDERAL ' || nm FROM o WHERE k % 6 = 3
  UNION ALL SELECT k, 1, 0, 'APTE', nm, ': ' || nm FROM o
  UNION ALL SELECT k, 2, j, 'APDO', 'José & Cia ' || j, ': José & Cia ' || j FROM o, unnest(range(1, k % 4 + 1)) t(j)
  UNION ALL SELECT k, 3, i, 'Seq ' || i, 'Juntada de peça ' || (k * 10 + i) || ' [Guia: ' || i || '] lixo',
                   'Juntada de peça ' || (k * 10 + i) || ' [Guia: ' || i || '] lixo'
            FROM o, unnest(range(0, k % 5)) t(i) WHERE k % 6 = 4
),
party AS (SELECT k, grp, j, papel, online AS nome FROM party0 WHERE online IS NOT NULL),
party_off AS (SELECT k, grp, j, papel, offline AS nome FROM party0),
moves AS (SELECT k, i, {_WHEN} AS data, {_MOVE_TEXT} AS texto FROM o, unnest(range(0, k % 5)) t(i))"""


def _extracted(party: str, judge: str, filed: str, legacy: str, moves: str, extra: str, name: str = "ext") -> str:
    return f"""
{name} AS (
  SELECT o.k, o.npu AS _id, o.npu AS numero_processo, {legacy} AS numero_legado, {filed} AS data_autuacao,
         {judge} AS relator, '{SITE}/processo/' || o.npu AS fonte_url, {extra},
         coalesce(p.t, '') AS envolvidos, coalesce(m.t, '') AS movimentacoes, o.status
  FROM o
  LEFT JOIN (SELECT k, string_agg(papel || '=' || nome, ';' ORDER BY grp, j) AS t FROM {party} GROUP BY k) p ON p.k = o.k
  LEFT JOIN (SELECT k, string_agg(data || '=' || texto, ';' ORDER BY i) AS t FROM {moves} GROUP BY k) m ON m.k = o.k
)"""


_LEGACY = "strftime(o.d, '%y') || '.05.' || o.k || '-' || (o.k % 10)"
_FILED_OFF = "CASE WHEN o.k % 3 = 1 AND o.k % 50 <> 49 THEN CAST(o.d AS VARCHAR) END"
_ONLINE_FIELDS = (
    "party",
    _JUDGE_ONLINE.replace("k %", "o.k %").replace("nm", "o.nm"),
    _FILED.replace("k %", "o.k %").replace("CAST(d", "CAST(o.d"),
    _LEGACY,
    "moves",
)
_ONLINE = _DETAIL + "," + _extracted(
    *_ONLINE_FIELDS,
    f"{_iso('o.k')} AS scraped_at, CAST(NULL AS VARCHAR) AS reprocessed_at, CAST(NULL AS VARCHAR) AS reprocessed_from_doc",
)
_OFFLINE = _DETAIL + "," + _extracted(
    "party_off",
    _JUDGE_OFFLINE.replace("k %", "o.k %").replace("nm", "o.nm"),
    _FILED_OFF,
    "CAST(NULL AS VARCHAR)",
    "(SELECT * FROM moves WHERE k % 6 = 5)",
    f"'2025-01-01T00:00:00' AS scraped_at, {_iso('o.k')} AS reprocessed_at, o.k::VARCHAR AS reprocessed_from_doc",
)
_AGAIN = _OFFLINE + "," + _extracted(
    *_ONLINE_FIELDS,
    f"'2025-02-01T00:00:00' AS scraped_at, {_iso('o.k')} AS reprocessed_at, o.k::VARCHAR AS reprocessed_from_doc",
    "again",
)
# the earlier table and how the second one merges into it
_OLD = _RECORDS.replace("rec AS", "rec0 AS", 1) + """,
rec AS (SELECT * REPLACE ('old' AS relator, 'old' AS reprocessed_from_doc) FROM rec0 WHERE status IN ('F', 'P'))"""

# list pages: ten orders per page, a hundred per crawl
_LISTS = f"""{_CASES},
lim AS (
  SELECT c_custkey AS c,
         CASE c_custkey % 4 WHEN 2 THEN 3 WHEN 3 THEN 20 ELSE 5 END AS mp,
         CASE c_custkey % 3 WHEN 1 THEN 7 WHEN 2 THEN 50 ELSE 10 END AS md
  FROM customer WHERE c_custkey % 10 < 4 AND c_custkey % 20 <> 0
),
it AS (
  SELECT k, npu, k // 10 AS ten, k // 100 AS c, (k // 10) % 10 AS idx,
         row_number() OVER (PARTITION BY k // 10 ORDER BY k) - 1 AS pos,
         count(*) OVER (PARTITION BY k // 100) AS n
  FROM o
),
pg AS (
  SELECT ten, it.c, idx, n, (n + 9) // 10 - 1 AS last, lpad(it.c::VARCHAR, 14, '0') AS cnpj,
         '{ROUTE}/' || lpad(it.c::VARCHAR, 14, '0') || '/' || idx AS url,
         coalesce(any_value(mp), 5) AS mp, coalesce(any_value(md), 10) AS md, any_value(mp) IS NOT NULL AS asked
  FROM it LEFT JOIN lim ON lim.c = it.c GROUP BY ten, it.c, idx, n
)"""


# the second request of a tax id reads other limits
_SECOND = f"SELECT * REPLACE (CASE WHEN asked THEN 2 ELSE mp END AS mp, CASE WHEN asked THEN 3 ELSE md END AS md) FROM pg"


def _frontier(where: str, url: str, pages: str = "SELECT * FROM pg", shift: int = 0) -> str:
    return f"""WITH {_LISTS},
lim_pg AS ({pages}),
r AS (
  SELECT it.*, p.cnpj, mp, md, row_number() OVER (PARTITION BY it.c ORDER BY it.idx, it.pos) AS rn
  FROM it JOIN lim_pg p USING (ten) WHERE it.pos < md AND {where}
)
SELECT ten + {shift} AS page_id, 'r' || (c + {shift}) AS crawl, c + {shift} AS req_id, cnpj, idx::INTEGER AS page_idx,
       pos::INTEGER AS pos, npu AS numero, {url} AS detail_url
FROM r WHERE rn <= mp * md"""


def _next_stable(pages: str = "SELECT * FROM pg", shift: int = 0) -> str:
    return f"""WITH {_LISTS}, lim_pg AS ({pages})
SELECT ten + {shift} AS page_id, 'r' || (c + {shift}) AS crawl, cnpj, idx + 1 AS page_idx, '{ROUTE}/' || cnpj || '/' || (idx + 1) AS next_url
FROM lim_pg WHERE idx + 1 < mp AND (idx < last OR idx < 5)"""


_STABLE_URL = f"CASE WHEN c % 2 = 0 THEN '{SITE}/processo/' ELSE '{SITE}/cp/processo/' END || npu"
_FORM_URL = f"CASE WHEN c % 2 = 0 THEN '{SITE}/processo/' ELSE '{PLAIN_SITE}/cp/processo/' END || npu"
_FRONTIER_STABLE = _frontier("true", _STABLE_URL)
_FRONTIER_REPEATED = f"({_FRONTIER_STABLE}) UNION ALL ({_frontier('true', _STABLE_URL, _SECOND, SECOND)})"

_LOG = """
fl AS (
  SELECT 'h' || (user_id % 4) AS host, event_id AS seq, epoch_us(ts) // 10 AS us,
         ['form', 'detail', 'list', 'stable_route', 'detalhe'][(event_id % 5 + 1)::INTEGER] AS endpoint,
         event_type = 'signup' AS ex,
         CASE WHEN event_type = 'signup' THEN CASE WHEN user_id % 3 = 0 THEN 'ValueError' ELSE 'TimeoutError' END END AS exception,
         CASE WHEN event_type <> 'signup' THEN CASE WHEN event_type = 'error' THEN 503 ELSE 200 END END AS status,
         event_type = 'view' AND user_id % 5 = 0 AS cf, event_id % 7 AS retry_times,
         [30.0, 45.0, 100.0][(event_id % 3 + 1)::INTEGER]::DOUBLE AS current_timeout
  FROM events
),
f AS (SELECT *, ex OR status = 503 OR cf AS failed FROM fl)"""
_HEALTH = f"""{_LOG},
s0 AS (
  SELECT *, row_number() OVER w AS n, sum(failed::INTEGER) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS rf,
         first_value(us) OVER w AS us0, last_value(CASE WHEN NOT failed THEN us END IGNORE NULLS) OVER w AS us_ok
  FROM f WINDOW w AS (PARTITION BY host ORDER BY seq)
),
s1 AS (
  SELECT *, n - coalesce(max(CASE WHEN NOT failed THEN n END) OVER (PARTITION BY host ORDER BY seq), 0) AS cons,
         coalesce(us_ok, us0) AS last_us, rf / least(n, 20) AS rate
  FROM s0
),
h AS (SELECT *, n >= 10 AND (rate > 0.5 OR cons > 5 OR us - last_us > 300000000) AS degraded FROM s1)"""
# the log of repeated attempts: the health states of its own two hosts
_CHAINED = _HEALTH.replace(
    "f AS (SELECT *, ex",
    """fc AS (SELECT * REPLACE ('h' || (seq // 7 % 2) AS host, ['list', 'form', 'stable_route', 'detail', 'list'][(seq // 7 % 5 + 1)::INTEGER] AS endpoint),
       seq // 7 AS r, CASE WHEN seq % 7 = 0 AND seq // 7 % 4 = 1 THEN 45.0 WHEN seq % 35 = 17 THEN 20.0 END AS logged FROM fl),
f AS (SELECT *, ex""",
).replace("AS failed FROM fl)", "AS failed FROM fc)")
_HEALTH_ROWS = f"""WITH {_HEALTH}
SELECT host, seq, us AS ts, failed, n, rf::BIGINT AS recent_failures, cons AS consecutive_failures,
       last_us AS last_success, round(rate, 6) AS failure_rate, degraded FROM h"""
_HEALTH_CHANGES = f"""WITH {_HEALTH},
c AS (SELECT *, lag(degraded, 1, false) OVER (PARTITION BY host ORDER BY seq) AS prev FROM h)
SELECT host, seq, us AS ts, CASE WHEN degraded THEN 'degraded' ELSE 'recovered' END AS change
FROM c WHERE degraded <> prev"""


def _signals(source: str) -> str:
    """Signals of a page relation with DuckDB's own regex engine."""
    cols = {"sig_case_header": C.CASE_HEADER}
    for prefix, patterns in (
        ("sig_judge", C.JUDGE_WORDS),
        ("sig_party", C.PARTY_WORDS_WIDE),
        ("sig_timeline", C.TIMELINE_WORDS),
        ("sig_total", [C.TOTAL_MARK]),
        ("sig_pager", C.PAGER_WORDS),
        ("sig_table", [f"(?s)<{t}[^>]*>.*?</{t}>" for t in ("TABLE", "TBODY", "TR")]),
        ("sig_error", C.ERROR_WORDS),
    ):
        for i, p in enumerate(patterns, 1):
            cols[f"{prefix}_{i}"] = p
    tests = ", ".join(f"regexp_matches(u, {_lit(p)}) AS {n}" for n, p in cols.items())
    return f"""WITH {_MIXED},
u AS (SELECT page_id, coalesce(html, '') AS html, upper(coalesce(html, '')) AS u FROM {source})
SELECT page_id, {tests}, regexp_matches(html, {_lit(C.NPU)}) AS sig_npu,
       len(regexp_extract_all(html, {_lit(C.NPU)})) > 1 AS sig_many_npu,
       contains(u, '<HTML') AS sig_html_tag, contains(u, '<BODY') AS sig_body_tag, length(trim(u)) < 100 AS sig_short
FROM u"""


# what the twelve kinds of mixed pages show, read off their texts
_SHOWN = {
    0: "npu party_1 html_tag body_tag",
    1: "short",
    2: "html_tag body_tag short",
    3: "body_tag",
    4: "error_1 html_tag body_tag",
    5: "html_tag body_tag",
    6: "total_1 html_tag body_tag",
    7: "pager_1 html_tag body_tag",
    8: "npu many_npu table_1 table_3 html_tag body_tag",
    9: "case_header judge_1 party_1 timeline_4 html_tag body_tag",
    10: "html_tag body_tag",
    11: "short",
}
_COUNTED = {"judge": 3, "party": 8, "timeline": 8, "total": 1, "pager": 6, "table": 3, "error": 12}


def _mixed_signals() -> str:
    names = ["case_header", "npu", "many_npu", "html_tag", "body_tag", "short"]
    names += [f"{n}_{i}" for n, most in _COUNTED.items() for i in range(1, most + 1)]
    kinds = {n: [str(k) for k, shown in _SHOWN.items() if n in shown.split()] for n in names}
    columns = [f"kind IN ({', '.join(ks)}) AS sig_{n}" if ks else f"false AS sig_{n}" for n, ks in kinds.items()]
    return f"WITH {_MIXED} SELECT page_id, {', '.join(columns)} FROM mixed"


_INTAKE_VALUE = f"""CASE
    WHEN q % 20 = 0 THEN tax[1:13]
    WHEN q % 10 < 4 THEN CASE WHEN q % 2 = 0 THEN tax[1:2] || '.' || tax[3:5] || '.' || tax[6:8] || '/' || tax[9:12] || '-' || tax[13:14] ELSE tax END
    WHEN q % 20 = 4 THEN '123'
    WHEN q % 10 < 8 THEN CASE WHEN q % 2 = 0 THEN npu ELSE replace(replace(npu, '-', ''), '.', '') END
    WHEN q % 20 = 8 THEN NULL ELSE '1' END"""
_REQUESTS = f"""
req0 AS (SELECT c_custkey AS q, lpad(c_custkey::VARCHAR, 14, '0') AS tax, {_npu('c_custkey', '2001')} AS npu FROM customer),
req AS (SELECT *, CASE WHEN q % 10 < 4 THEN 'cnpj' WHEN q % 10 < 8 THEN 'numero' WHEN q % 10 = 8 THEN 'outro' END AS modo,
        {_INTAKE_VALUE} AS valor FROM req0)"""

_WATCH = f"""{_RECORDS},
w AS (SELECT {_npu('c_custkey', '1995 + c_custkey % 7')} AS npu FROM customer),
ws AS (SELECT npu, _id, relator, data_autuacao FROM w LEFT JOIN rec ON _id = npu)"""

_VIOL_RECORDS = f"""{_RECORDS},
vr AS (
  SELECT _id, list_filter([
      CASE WHEN k % 11 = 0 THEN 'data_autuacao:pattern' END,
      CASE WHEN k % 4 = 3 THEN 'envolvidos.papel:required' END,
      CASE WHEN k % 17 = 0 THEN 'movimentacoes:type' END,
      CASE WHEN k % 17 <> 0 AND k % 5 = 4 THEN 'movimentacoes.data:pattern' END
    ], lambda x: x IS NOT NULL) AS v FROM rec
)"""

_ORACLE: dict[str, str] = {
    "land_raw_pages": f"""
SELECT page_id, url, 'GET' AS method, 200 AS status, 'text/html; título' AS content_type, length(html)::INTEGER AS n_chars,
       CAST(NULL AS VARCHAR) AS payload,
       CASE page_id % 3 WHEN 0 THEN 'lista' WHEN 1 THEN 'detalhe' END AS tipo,
       CASE WHEN page_id % 2 = 0 THEN 'numero' ELSE 'cnpj' END AS busca, CAST(NULL AS VARCHAR) AS numero,
       CASE WHEN page_id % 2 = 1 THEN lpad(page_id::VARCHAR, 14, '0') END AS cnpj,
       CASE WHEN page_id % 4 = 0 THEN (page_id % 8)::INTEGER END AS page_idx, CAST(NULL AS VARCHAR) AS endpoint,
       {_iso('page_id % 50')} AS fetched_at, 'sha256:' || sha256(html) AS hash_html
FROM pages""",
    "select_raw_pages": f"""
SELECT page_id, url, {_iso('page_id % 50')} AS fetched_at FROM pages
WHERE page_id % 3 = 0 AND page_id % 2 = 1 AND html <> ''
ORDER BY page_id % 50 DESC, page_id DESC LIMIT 20 OFFSET 5""",
    "select_deep_pages": f"""WITH {_MIXED}
SELECT page_id, url, fetched_at FROM mixed WHERE tipo = 'detalhe' AND html <> ''
ORDER BY fetched_at DESC, page_id DESC LIMIT 1500 OFFSET 1200""",
    "upsert_processos": f"""WITH {_RECORDS}
SELECT _id, numero_processo, numero_legado, data_autuacao, CASE WHEN status = 'P' THEN 'old' ELSE relator END AS relator,
       fonte_url, scraped_at, reprocessed_at,
       CASE WHEN status = 'P' OR (status = 'F' AND k % 3 = 0) THEN 'old' ELSE reprocessed_from_doc END AS reprocessed_from_doc,
       envolvidos, movimentacoes
FROM rec""",
    "upsert_actions": f"""WITH {_CASES}
SELECT npu AS _id, k * 4 + r AS seq, CASE WHEN status = 'O' AND r = 0 THEN 'insert' ELSE 'update' END AS action
FROM o, unnest(range(0, k % 3 + 1)) t(r) WHERE status IN ('F', 'O')""",
    "compact_snapshot": f"WITH {_RECORDS} SELECT {_RECORD_COLUMNS} FROM rec",
    "layout_write": f"""WITH {_MIXED}
SELECT coalesce(tipo, 'undefined') AS tipo, count(*) AS n, min(fetched_at) AS first_at, max(fetched_at) AS last_at,
       count(numero) AS n_numero FROM mixed GROUP BY 1""",
    "layout_lookup": f"""WITH {_MIXED},
q AS (SELECT c_custkey AS q, c_name AS nm, {_npu('c_custkey', '1995 + c_custkey % 7')} AS npu, lpad(c_custkey::VARCHAR, 14, '0') AS tax FROM customer)
SELECT 'by_url' AS lookup, url AS key, page_id::VARCHAR AS found FROM mixed JOIN q ON url = '{SITE}/pagina/' || q.q
UNION ALL SELECT 'by_numero', numero, page_id::VARCHAR FROM mixed JOIN q ON numero = q.npu
UNION ALL SELECT 'by_cnpj', q.tax, page_id::VARCHAR FROM mixed JOIN q ON busca = 'cnpj' AND page_id = q.q
UNION ALL SELECT 'by_judge', relator, _id FROM rec JOIN q ON relator = q.nm
UNION ALL SELECT 'by_scraped_at', scraped_at, _id FROM rec WHERE scraped_at >= (SELECT max(scraped_at)[1:10] FROM rec)""",
    "page_integrity": "SELECT page_id, false AS hash_ok FROM pages WHERE page_id % 4 = 0",
    "repeated_captures": f"""WITH {_MIXED}
SELECT 'sha256:' || sha256(html) AS hash_html, count(*) AS n, min(page_id) AS first_page_id
FROM mixed GROUP BY 1 HAVING count(*) > 1""",
    "processos_by_judge": f"""WITH {_RECORDS}
SELECT relator, data_autuacao, _id, rn::INTEGER AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY relator ORDER BY data_autuacao DESC NULLS LAST, _id) AS rn
  FROM rec WHERE relator IS NOT NULL) WHERE rn <= 3""",
    "request_intake": f"""WITH {_REQUESTS}
SELECT q AS req_id, modo, valor,
       CASE modo WHEN 'cnpj' THEN regexp_replace(valor, '[^0-9]', '', 'g') WHEN 'numero' THEN CASE WHEN valor = '123' THEN valor ELSE npu END END AS valor_normalizado,
       CASE WHEN modo IS NULL OR valor IS NULL THEN 'missing_parameter' WHEN modo = 'outro' THEN 'invalid_mode'
            WHEN q % 20 = 4 THEN 'invalid_npu' WHEN q % 20 = 0 THEN 'invalid_cnpj' END AS reject_reason
FROM req""",
    "seed_requests": f"""WITH {_REQUESTS}
SELECT q AS req_id, CASE modo WHEN 'numero' THEN '{SITE}/cp/' ELSE '{ROUTE}/' || tax || '/0' END AS url,
       CASE modo WHEN 'numero' THEN 'form' ELSE 'lista' END AS tipo, modo AS busca,
       CASE modo WHEN 'numero' THEN npu END AS numero, CASE modo WHEN 'cnpj' THEN tax END AS cnpj,
       CASE modo WHEN 'cnpj' THEN 0 END AS page_idx, CASE modo WHEN 'numero' THEN 'form' ELSE 'stable_route' END AS endpoint
FROM req WHERE q % 10 < 8 AND q % 20 NOT IN (0, 4)""",
    "crawl_limits": """
SELECT c_custkey AS req_id, mp AS max_pages, md AS max_details_per_page, mp * md AS max_total_details FROM (
  SELECT c_custkey, CASE c_custkey % 4 WHEN 2 THEN 3 WHEN 3 THEN 20 ELSE 5 END AS mp,
         CASE c_custkey % 3 WHEN 1 THEN 7 WHEN 2 THEN 50 ELSE 10 END AS md FROM customer)""",
    "validate_raw_pages": f"""WITH {_MIXED}
SELECT page_id, array_to_string(list_filter([
    CASE WHEN page_id % 15 = 7 THEN 'url:required' END,
    CASE WHEN html IS NULL THEN 'html:required' END,
    CASE WHEN tipo IS NULL THEN 'context.tipo:required' END,
    CASE WHEN page_id % 16 = 9 THEN 'fetched_at:required' END,
    CASE WHEN page_id % 10 IN (3, 4) THEN 'method:enum' END,
    CASE WHEN page_id % 14 IN (5, 6) THEN 'status:range' END,
    CASE WHEN tipo = 'outro' THEN 'context.tipo:enum' END,
    CASE WHEN numero = '123' THEN 'context.numero:pattern' END,
    CASE WHEN page_idx < 0 THEN 'context.page_idx:minimum' END,
    CASE WHEN page_id % 16 = 8 THEN 'fetched_at:pattern' END,
    CASE WHEN page_id % 18 = 10 THEN 'hash_html:pattern' END
  ], lambda x: x IS NOT NULL), ',') AS violations FROM mixed""",
    "validate_processos": f"WITH {_VIOL_RECORDS} SELECT _id, array_to_string(v, ',') AS violations FROM vr",
    "quarantine_processos": f"WITH {_VIOL_RECORDS} SELECT _id, len(v)::INTEGER AS n FROM vr WHERE len(v) > 0",
    "violation_summary": f"""WITH {_VIOL_RECORDS}
SELECT rule, count(*) AS n FROM (SELECT unnest(v) AS rule FROM vr) GROUP BY rule""",
    "date_normalize": f"""WITH {_CASES},
i AS (SELECT k // 1000 AS batch_id, CASE k % 5 WHEN 0 THEN CAST(d AS VARCHAR) WHEN 1 THEN CAST(d AS VARCHAR) || 'T03:05:00'
      WHEN 2 THEN CAST(d AS VARCHAR) || 'T23:59:00' END AS iso FROM o)
SELECT batch_id, count(*) AS n, count(CASE WHEN length(iso) = 10 THEN 1 END) AS n_date,
       count(CASE WHEN length(iso) > 10 THEN 1 END) AS n_datetime, count(*) - count(iso) AS n_failed,
       min(iso) AS first_iso, max(iso) AS last_iso FROM i GROUP BY batch_id""",
    "judge_directory": f"""WITH {_CASES}
SELECT relator, count(*) AS n_cases, count(DISTINCT v) AS n_spellings FROM (
  SELECT CASE WHEN k % 6 = 3 THEN 'JUÍZA FEDERAL ' || nm ELSE nm END AS relator, k % 6 AS v FROM o) GROUP BY relator""",
    "page_signals": _signals("pages"),
    "page_signals_mixed": _mixed_signals(),
    "classify_pages": f"WITH {_MIXED} SELECT page_id, page_class FROM mixed",
    "classify_site_pages": "SELECT 'error' AS page_class, count(*) AS n FROM pages",
    "page_rules": f"""WITH {_MIXED}
SELECT page_id, page_class = 'detail' AS is_detail, page_class = 'list' AS is_list, page_class = 'error' AS is_error FROM mixed""",
    "classify_stable_list": f"""WITH {_LISTS}
SELECT 'list' AS source, ten AS page_id, 'list' AS page_class FROM pg
UNION ALL SELECT 'mixed', k, 'error' FROM o""",
    "classify_listed": f"""WITH {_LISTS}
SELECT ten AS page_id, CASE WHEN c % 3 = 1 THEN 'detail' ELSE 'list' END AS page_class FROM pg""",
    "label_confusion": f"""WITH {_MIXED}
SELECT coalesce(tipo, 'undefined') AS stored, page_class AS computed, count(*) AS n FROM mixed GROUP BY 1, 2""",
    "page_indicator_report": f"""WITH u AS (SELECT html, upper(html) AS u FROM pages),
c AS (SELECT count(*) AS pages, count(CASE WHEN regexp_matches(html, {_lit(C.NPU)}) THEN 1 END) AS npu,
    count(CASE WHEN contains(u, 'PROCESSO') THEN 1 END) AS processo_ref, count(CASE WHEN contains(u, 'RELATOR') THEN 1 END) AS relator,
    count(CASE WHEN contains(u, 'DESEMBARGADOR') THEN 1 END) AS desembargador,
    count(CASE WHEN contains(u, 'AUTOR') OR contains(u, 'REU') OR contains(u, 'RÉU') OR contains(u, 'ADVOGADO') THEN 1 END) AS envolvidos,
    count(CASE WHEN contains(u, 'MOVIMENTAÇÃO') OR contains(u, 'ANDAMENTO') OR contains(u, 'JUNTADA') THEN 1 END) AS movimentacao,
    count(CASE WHEN regexp_matches(html, '[0-9]/[0-9]{{1,2}}/[0-9]{{4}}') THEN 1 END) AS data_formato,
    count(CASE WHEN contains(u, 'AUTUADO') THEN 1 END) AS autuacao FROM u)
SELECT pages, indicator, hits FROM c UNPIVOT (hits FOR indicator IN (npu, processo_ref, relator, desembargador, envolvidos, movimentacao, data_formato, autuacao))""",
    "page_indicator_report_mixed": f"""WITH {_MIXED}
SELECT (SELECT count(*) FROM mixed WHERE page_class <> 'detail') AS pages, i.indicator,
       CASE i.indicator WHEN 'npu' THEN (SELECT count(*) FROM mixed WHERE kind = 8)
            WHEN 'processo_ref' THEN (SELECT count(*) FROM mixed WHERE kind = 5) ELSE 0 END AS hits
FROM (SELECT unnest(['npu', 'processo_ref', 'relator', 'desembargador', 'envolvidos', 'movimentacao', 'data_formato', 'autuacao']) AS indicator) i""",
    "page_cells": f"""WITH {_CASES},
b AS (SELECT *, CASE WHEN k % 6 IN (0, 3) THEN 1 ELSE 0 END AS jr FROM o),
cells AS (
  SELECT k, 0 AS r, 0 AS c, CASE k % 6 WHEN 0 THEN 'RELATOR' ELSE 'Relatora' END AS t FROM b WHERE jr = 1
  UNION ALL SELECT k, 0, 1, CASE k % 6 WHEN 0 THEN ':' ELSE 'JUÍZA FEDERAL ' || nm END FROM b WHERE jr = 1
  UNION ALL SELECT k, jr, 0, 'APTE' FROM b UNION ALL SELECT k, jr, 1, ': ' || nm FROM b
  UNION ALL SELECT k, jr + j, 0, 'APDO' FROM b, unnest(range(1, k % 4 + 1)) t(j)
  UNION ALL SELECT k, jr + j, 1, ': José & Cia ' || j FROM b, unnest(range(1, k % 4 + 1)) t(j)
  UNION ALL SELECT k, jr + 1 + k % 4, 0, 'ADV' FROM b UNION ALL SELECT k, jr + 1 + k % 4, 1, '' FROM b
  UNION ALL SELECT k, jr + 2 + k % 4 + 2 * i, 0, 'Em ' || strftime(d + i::INTEGER, '%d/%m/%Y') || ' ' || lpad((k % 24)::VARCHAR, 2, '0')
       || ':' || lpad((k % 60)::VARCHAR, 2, '0') FROM b, unnest(range(0, k % 5)) t(i) WHERE k % 6 <> 5
  UNION ALL SELECT k, jr + 3 + k % 4 + 2 * i, 0, CASE WHEN k % 6 = 4 THEN 'Seq ' || i ELSE '' END FROM b, unnest(range(0, k % 5)) t(i) WHERE k % 6 <> 5
  UNION ALL SELECT k, jr + 3 + k % 4 + 2 * i, 1, 'Juntada de peça ' || (k * 10 + i) || ' [Guia: ' || i || '] lixo'
       FROM b, unnest(range(0, k % 5)) t(i) WHERE k % 6 <> 5
)
SELECT k AS page_id, r::INTEGER AS row_idx, c::INTEGER AS cell_idx, t AS text FROM cells""",
    "extract_numero": f"WITH {_CASES} SELECT k AS page_id, npu AS numero FROM o",
    "extract_legado": f"WITH {_CASES} SELECT k AS page_id, {_LEGACY} AS numero_legado FROM o",
    "extract_data_autuacao": f"WITH {_CASES} SELECT k AS page_id, {_FILED} AS data_autuacao FROM o",
    "extract_data_autuacao_offline": f"WITH {_CASES} SELECT k AS page_id, {_FILED_OFF} AS data_autuacao FROM o",
    "page_cells_nested": f"""WITH {_CASES},
b AS (SELECT *, CASE WHEN k % 4 = 3 THEN 1 ELSE 0 END AS jr, 'DESEMBARGADOR FEDERAL ' || nm AS judge FROM o),
cells AS (
  SELECT k, 0 AS r, 0 AS c, 'Menu' AS raw, 'Menu' AS t FROM b
  UNION ALL SELECT k, 0, 1, '', 'RELATOR' FROM b
  UNION ALL SELECT k, 0, 2, 'Rodape ' || k, 'Rodape ' || k FROM b
  UNION ALL SELECT k, 1, 0, 'RELATOR', 'RELATOR' FROM b
  UNION ALL SELECT k, 1, 1, CASE jr WHEN 1 THEN '' ELSE ': <b>' || judge || '</b>' END, CASE jr WHEN 1 THEN judge ELSE ':' END FROM b
  UNION ALL SELECT k, 2, 0, judge, judge FROM b WHERE jr = 1
  UNION ALL SELECT k, jr + 2, 0, 'APTE', 'APTE' FROM b
  UNION ALL SELECT k, jr + 2, 1, '', nm FROM b
  UNION ALL SELECT k, jr + 2, 2, 'resto ' || k, 'resto ' || k FROM b
  UNION ALL SELECT k, jr + 3, 0, nm, nm FROM b
  UNION ALL SELECT k, jr + 3, 1, 'Valor ' || k, 'Valor ' || k FROM b
  UNION ALL SELECT k, jr + 3 + j, 0, 'APDO', 'APDO' FROM b, unnest(range(1, k % 3 + 1)) t(j)
  UNION ALL SELECT k, jr + 3 + j, 1, ': Parte ' || j, ': Parte ' || j FROM b, unnest(range(1, k % 3 + 1)) t(j)
)
SELECT k AS page_id, r::INTEGER AS row_idx, c AS cell_idx, raw, t AS text FROM cells""",
    "extract_envolvidos_nested": f"""WITH {_CASES},
pairs AS (
  SELECT k, 0 AS j, 'Menu' AS papel, 'RELATOR' AS nome FROM o
  UNION ALL SELECT k, 1, 'APTE', nm FROM o
  UNION ALL SELECT k, 2, nm, 'Valor ' || k FROM o
  UNION ALL SELECT k, 2 + j, 'APDO', 'Parte ' || j FROM o, unnest(range(1, k % 3 + 1)) t(j)
)
SELECT k AS page_id, j::INTEGER AS pos, papel, nome FROM pairs""",
    "extract_relator_nested": f"WITH {_CASES} SELECT k AS page_id, nm AS relator FROM o",
    "extract_relator": f"WITH {_CASES} SELECT k AS page_id, {_JUDGE_ONLINE} AS relator FROM o",
    "extract_relator_offline": f"WITH {_CASES} SELECT k AS page_id, {_JUDGE_OFFLINE} AS relator FROM o",
    "extract_envolvidos": f"""WITH {_DETAIL}
SELECT k AS page_id, (row_number() OVER (PARTITION BY k ORDER BY grp, j) - 1)::INTEGER AS pos, papel, nome FROM party""",
    "extract_envolvidos_offline": f"""WITH {_DETAIL}
SELECT k AS page_id, (row_number() OVER (PARTITION BY k ORDER BY grp, j) - 1)::INTEGER AS pos, papel, nome FROM party_off""",
    "extract_movimentacoes": f"WITH {_DETAIL} SELECT k AS page_id, i::INTEGER AS pos, data, texto FROM moves",
    "extract_movimentacoes_offline": f"""WITH {_DETAIL}
SELECT k AS page_id, i::INTEGER AS pos, data, texto FROM moves WHERE k % 6 = 5""",
    "extract_movimentacoes_long": r"""
WITH t AS (SELECT doc_id, trim(regexp_replace(text, '[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]+', ' ', 'g')) AS t FROM documents)
SELECT doc_id AS page_id, 0 AS pos, '2002-02-01T03:04:00' AS data, length(t)::INTEGER AS n_chars, sha256(t) AS digest
FROM t WHERE length(t) > 5""",
    "extract_processos": f"WITH {_ONLINE} SELECT {_RECORD_COLUMNS} FROM ext",
    "extract_processos_offline": f"WITH {_OFFLINE} SELECT {_RECORD_COLUMNS} FROM ext",
    "form_fields": f"""
SELECT c_custkey AS page_id, 'sessao' AS name, 'dup' || c_custkey AS value FROM customer
UNION ALL SELECT c_custkey, 'token', 'a&' || c_custkey FROM customer UNION ALL SELECT c_custkey, 'vazio', '' FROM customer
UNION ALL SELECT c_custkey, 'tipo', CASE WHEN c_custkey % 2 = 0 THEN 'xmlproc' ELSE 'xmlcpf' END FROM customer
UNION ALL SELECT c_custkey, 'filtro', CASE WHEN c_custkey % 2 = 0 THEN {_npu('c_custkey', '2001')} ELSE lpad(c_custkey::VARCHAR, 14, '0') END FROM customer""",
    "inputs_by_keyword": "SELECT c_custkey AS page_id, 'NumProcesso' AS input_name FROM customer",
    "page_links": """
WITH a AS (SELECT page_id, string_split(html, '<a ') AS parts FROM pages),
b AS (SELECT page_id, unnest(parts[2:]) AS p, unnest(range(0, len(parts) - 1)) AS pos FROM a)
SELECT page_id, pos::INTEGER AS pos, replace(regexp_extract(p, 'href="([^"]*)"', 1), '&amp;', '&') AS href, CAST(NULL AS VARCHAR) AS npu FROM b""",
    "page_links_rendered": f"""WITH {_LISTS},
a AS (
  SELECT ten, 0 AS grp, pos AS j, CASE WHEN c % 2 = 0 THEN '/processo/' ELSE '{PLAIN_SITE}/cp/processo/' END || npu AS href, npu AS text, npu FROM it
  UNION ALL SELECT ten, 2, 0, '?page=' || (idx + 1), 'Próxima', NULL FROM pg WHERE idx < last
  UNION ALL SELECT ten, 1, j, '?page=' || [0, idx - 1, idx - 1][j], ['Primeira', '<', 'anterior'][j], NULL FROM pg, unnest([1, 2, 3]) t(j) WHERE idx > 0
  UNION ALL SELECT ten, 3, 0, '?page=' || last, '>>', NULL FROM pg WHERE c % 2 = 0
  UNION ALL SELECT ten, 4, j, '?page=' || j, j::VARCHAR, NULL FROM pg, unnest(range(0, last + 1)) t(j)
)
SELECT ten AS page_id, (row_number() OVER (PARTITION BY ten ORDER BY grp, j) - 1)::INTEGER AS pos, href, text, npu FROM a""",
    "best_detail_link": f"""WITH {_CASES},
b AS (SELECT k, npu, CASE k % 4 WHEN 0 THEN '/processo/' || npu WHEN 1 THEN '../processo/' || npu2
      WHEN 2 THEN '/x/processo/' || npu || '?a=1' ELSE '/processo/lista' END AS href,
      CASE k % 4 WHEN 0 THEN 185 WHEN 1 THEN 85 WHEN 2 THEN 175 ELSE 10 END AS score FROM o)
SELECT k AS page_id, npu AS numero, href, score, '{SITE}' || replace(href, '../', '/cp/') AS detail_url FROM b""",
    "frontier_form": _frontier("it.c % 3 <> 1", _FORM_URL),
    "frontier_stable": _FRONTIER_STABLE,
    "frontier_repeated": _FRONTIER_REPEATED,
    "list_totals": f"""WITH {_LISTS}
SELECT ten AS page_id, CASE WHEN c % 3 <> 2 THEN n END AS total, 10 AS page_size, CASE WHEN c % 3 <> 2 THEN last END AS last_page FROM pg""",
    "stable_totals": f"WITH {_LISTS} SELECT ten AS page_id, CASE WHEN c % 3 <> 2 THEN n END AS total FROM pg",
    "nav_links": f"""WITH {_LISTS}
SELECT ten AS page_id, CASE WHEN idx < last THEN idx + 1 END AS next_page, last AS last_page,
       CASE WHEN idx > 0 THEN 0::BIGINT END AS first_page, CASE WHEN idx > 0 THEN idx - 1 END AS prev_page, array_to_string([p::VARCHAR for p in range(0, last + 1)], ',') AS page_numbers,
       idx < last AS has_next, idx > 0 AS has_prev, true AS has_last, idx > 0 AS has_first FROM pg""",
    "page_ranges": """
WITH s AS (SELECT c_custkey AS q, c_custkey % 4 - 1 AS cur, CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 13 - 1 END AS last, c_custkey % 6 + 1 AS mx FROM customer),
b AS (SELECT q, greatest(cur, 0) AS lo, CASE WHEN last IS NULL OR last < 0 THEN greatest(cur, 0)
      ELSE greatest(least(cur + mx - 1, last), greatest(cur, 0)) END AS hi FROM s)
SELECT q AS state_id, unnest(range(lo, hi + 1)) AS page_idx FROM b""",
    "next_pages_form": f"""WITH {_LISTS},
p AS (SELECT *, unnest(range(idx + 1, greatest(least(mp - 1, last), idx + 1) + 1)) AS page_idx FROM pg WHERE c % 3 = 0 AND idx + 1 < mp)
SELECT ten AS page_id, 'r' || c AS crawl, cnpj, page_idx, url || '?page=' || page_idx AS next_url FROM p
UNION ALL SELECT ten, 'r' || c, cnpj, idx + 1, url || '?page=' || (idx + 1) FROM pg WHERE c % 3 = 2 AND idx + 1 < mp AND idx < last""",
    "next_pages_stable": _next_stable(),
    "next_pages_repeated": f"({_next_stable()}) UNION ALL ({_next_stable(_SECOND, SECOND)})",
    "frontier_coverage": f"""WITH fr AS ({_FRONTIER_STABLE}), {_CASES},
l AS (SELECT fr.crawl, fr.cnpj, o.status <> 'P' AS done FROM fr JOIN o ON o.npu = fr.numero)
SELECT crawl, cnpj, count(*) AS discovered, count(CASE WHEN done THEN 1 END) AS fetched, count(CASE WHEN NOT done THEN 1 END) AS missing
FROM l GROUP BY crawl, cnpj""",
    "frontier_coverage_repeated": f"""WITH fr AS ({_FRONTIER_REPEATED}), {_CASES}
SELECT crawl, cnpj, count(*) AS discovered, count(CASE WHEN status <> 'P' THEN 1 END) AS fetched, count(CASE WHEN status = 'P' THEN 1 END) AS missing
FROM fr JOIN o ON o.npu = fr.numero GROUP BY crawl, cnpj""",
    "missing_details": f"""WITH fr AS ({_FRONTIER_STABLE}), {_CASES}
SELECT fr.numero, fr.crawl, fr.cnpj FROM fr JOIN o ON o.npu = fr.numero WHERE status = 'P'""",
    "done_details": f"""WITH fr AS ({_FRONTIER_STABLE}), {_CASES}
SELECT fr.numero, fr.crawl, fr.cnpj FROM fr JOIN o ON o.npu = fr.numero WHERE status <> 'P'""",
    "fetch_failures": f"""WITH {_LOG}
SELECT host, seq, status, status = 503 AS status_retry, cf AS content_failure, NOT failed AS success,
       CASE WHEN status = 503 THEN 'status' WHEN cf THEN 'content' ELSE 'none' END AS retry_reason FROM f WHERE NOT ex""",
    "exception_class": f"""WITH {_LOG}
SELECT host, seq, exception, exception = 'TimeoutError' AS retryable, true AS is_failure FROM f WHERE ex""",
    "server_health": _HEALTH_ROWS,
    "health_transitions": _HEALTH_CHANGES,
    "health_snapshot": f"""WITH {_HEALTH},
l AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY host ORDER BY seq DESC) = 1)
SELECT host, CASE WHEN degraded THEN 'degraded' ELSE 'healthy' END AS status, round(rate, 6) AS failure_rate,
       cons AS consecutive_failures, last_us AS last_success, least(n, 100) AS sample_size, rf::BIGINT AS recent_failures,
       least(n, 20) AS total_requests FROM l""",
    "health_snapshot_hosts": f"""WITH {_HEALTH},
l AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY host ORDER BY seq DESC) = 1),
n AS (SELECT DISTINCT 'h' || (c_custkey % 6) AS host FROM customer)
SELECT n.host, CASE WHEN l.host IS NULL THEN 'unknown' WHEN degraded THEN 'degraded' ELSE 'healthy' END AS status, round(rate, 6) AS failure_rate,
       cons AS consecutive_failures, last_us AS last_success, CASE WHEN l.n > 100 THEN 100 ELSE l.n END AS sample_size,
       rf::BIGINT AS recent_failures, CASE WHEN l.n > 20 THEN 20 ELSE l.n END AS total_requests FROM n LEFT JOIN l USING (host)""",
    "retry_plan": f"""WITH {_HEALTH},
dim(endpoint, mx, dm, tm) AS (VALUES ('form', 3, 1.5::DOUBLE, 1.2::DOUBLE), ('detail', 4, 1.0, 1.0), ('list', 5, 2.0, 1.5), ('stable_route', 6, 0.8, 0.9)),
a AS (SELECT h.*, retry_times + 1 AS attempt, coalesce(mx, 5) AS mx, coalesce(dm, 1.0) AS dm, coalesce(tm, 1.0) AS tm
      FROM h LEFT JOIN dim USING (endpoint) WHERE exception = 'TimeoutError' OR status = 503 OR cf),
d AS (SELECT *, CASE WHEN attempt <= mx THEN least(power(2.0, attempt - 1) * dm, 60.0) * CASE WHEN degraded THEN 2.0 ELSE 1.0 END END AS base FROM a)
SELECT host, seq, endpoint, attempt::INTEGER AS attempt, mx AS max_retries, attempt > mx AS give_up, degraded,
       round(base * 0.5, 6) AS delay_lo, round(base * 1.5, 6) AS delay_hi,
       CASE WHEN attempt <= mx THEN round(CASE WHEN degraded THEN least(current_timeout * tm, 120.0) ELSE current_timeout END, 6)::DOUBLE END AS timeout_sec FROM d""",
    "retry_chains": f"""WITH RECURSIVE {_CHAINED},
dim(endpoint, mx, tm) AS (VALUES ('form', 3, 1.2::DOUBLE), ('detail', 4, 1.0), ('list', 5, 1.5), ('stable_route', 6, 0.9)),
a AS (SELECT host, seq, r, endpoint, retry_times AS times, degraded, coalesce(mx, 5) AS mx, coalesce(tm, 1.0) AS tm, logged,
             exception IS NOT DISTINCT FROM 'TimeoutError' OR coalesce(status = 503, false) OR cf AS retryable FROM h LEFT JOIN dim USING (endpoint)),
b AS (SELECT *, logged IS NULL AND coalesce(lag(g) OVER (PARTITION BY r ORDER BY seq), false) AS chained
      FROM (SELECT *, retryable AND times + 1 <= mx AS g FROM a)),
t AS (
  SELECT *, coalesce(logged, 30.0)::DOUBLE AS cur FROM b WHERE NOT chained
  UNION ALL
  SELECT b.*, CASE WHEN t.degraded THEN least(t.cur * t.tm, 120.0) ELSE t.cur END FROM t JOIN b ON b.r = t.r AND b.times = t.times + 1 AND b.chained
)
SELECT host, seq, endpoint, (times + 1)::INTEGER AS attempt, times + 1 > mx AS give_up, degraded,
       CASE WHEN times + 1 <= mx THEN round(CASE WHEN degraded THEN least(cur * tm, 120.0) ELSE cur END, 6)::DOUBLE END AS timeout_sec
FROM t WHERE retryable""",
    "collection_counts": """
SELECT 'raw_pages' AS collection, count(*) AS n FROM orders UNION ALL SELECT 'processos', count(*) FROM orders
UNION ALL SELECT 'crawl_requests', count(*) FROM customer UNION ALL SELECT 'fetch_log', count(*) FROM events""",
    "pages_by_type": f"""WITH {_MIXED}
SELECT coalesce(tipo, 'undefined') AS tipo, count(*) AS n FROM mixed GROUP BY 1 UNION ALL SELECT 'Total', count(*) FROM mixed""",
    "field_coverage": f"""WITH {_RECORDS},
c AS (SELECT count(*) AS total, count(CASE WHEN relator <> '' THEN 1 END) AS relator, count(CASE WHEN n_env > 0 THEN 1 END) AS envolvidos,
      count(CASE WHEN n_mov > 0 THEN 1 END) AS movimentacoes FROM rec)
SELECT total, field, n, floor(n * 100 / total + 0.5)::BIGINT AS pct FROM c UNPIVOT (n FOR field IN (relator, envolvidos, movimentacoes))""",
    "recent_pages": f"""
SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'lista' WHEN 1 THEN 'detalhe' ELSE 'N/A' END AS tipo,
       CASE WHEN page_id % 2 = 0 THEN 'numero' ELSE 'cnpj' END AS busca,
       CASE WHEN page_id % 2 = 1 THEN lpad(page_id::VARCHAR, 14, '0') ELSE 'N/A' END AS identificador,
       CASE WHEN page_id % 4 = 0 THEN (page_id % 8)::INTEGER END AS page_idx, url, {_iso('page_id % 50')} AS fetched_at
FROM pages ORDER BY page_id DESC LIMIT 10""",
    "recent_processos": f"""WITH {_RECORDS}
SELECT numero_processo AS numero, coalesce(nullif(relator, ''), 'N/A') AS relator, coalesce(data_autuacao, 'N/A') AS data_autuacao,
       CASE WHEN n_env > 0 THEN 'APTE - Parte 1' ELSE 'N/A' END AS primeiro_envolvido, coalesce(first_mov, 'N/A') AS ultima_movimentacao, scraped_at
FROM rec ORDER BY _id DESC LIMIT 5""",
    "watchlist_check": f"""WITH {_WATCH}
SELECT npu, CASE WHEN _id IS NULL THEN 'FALTANDO' ELSE 'OK' END AS situacao,
       CASE WHEN _id IS NOT NULL THEN coalesce(nullif(relator, ''), 'N/A') END AS relator,
       CASE WHEN _id IS NOT NULL THEN coalesce(data_autuacao, 'N/A') END AS data_autuacao FROM ws""",
    "watchlist_totals": f"""WITH {_WATCH}
SELECT count(*) AS total, count(_id) AS encontrados, count(*) - count(_id) AS faltantes FROM ws""",
    "watchlist_missing": f"WITH {_WATCH} SELECT npu FROM ws WHERE _id IS NULL",
    "missing_fields": f"""WITH {_RECORDS},
c AS (SELECT count(*) AS total, count(*) AS numero_processo, count(CASE WHEN relator <> '' THEN 1 END) AS relator, count(data_autuacao) AS data_autuacao,
      count(CASE WHEN n_env > 0 THEN 1 END) AS envolvidos, count(CASE WHEN n_mov > 0 THEN 1 END) AS movimentacoes FROM rec)
SELECT total, field, filled, total - filled AS missing FROM c UNPIVOT (filled FOR field IN (numero_processo, relator, data_autuacao, envolvidos, movimentacoes))""",
    "non_iso_dates": f"WITH {_RECORDS} SELECT count(*) AS total, count(CASE WHEN k % 11 = 0 THEN 1 END) AS non_iso FROM rec",
    "untitled_check": f"""WITH {_RECORDS},
t AS (SELECT _id, relator FROM rec WHERE k % 13 = 2)
SELECT 'count' AS kind, CAST(NULL AS VARCHAR) AS _id, CAST(NULL AS VARCHAR) AS relator, count(*) AS n FROM t
UNION ALL SELECT * FROM (SELECT 'sample', _id, relator, CAST(NULL AS BIGINT) FROM t ORDER BY _id LIMIT 3)""",
    "party_stats": f"""WITH {_RECORDS}
SELECT count(*) AS total, floor(avg(n_env) * 100 + 0.5) / 100 AS media, max(n_env)::INTEGER AS maximo, min(n_env)::INTEGER AS minimo FROM rec WHERE n_env > 0""",
    "movement_stats": f"""WITH {_RECORDS}
SELECT count(*) AS total, floor(avg(n_mov) * 100 + 0.5) / 100 AS media, max(n_mov)::INTEGER AS maximo, min(n_mov)::INTEGER AS minimo FROM rec WHERE n_mov > 0""",
    "cnpj_discovery": f"""WITH {_MIXED},
c AS (SELECT coalesce(tipo, 'undefined') AS tipo, page_idx FROM mixed WHERE busca = 'cnpj')
SELECT 'tipo:' || tipo AS metric, count(*) AS value FROM c GROUP BY tipo
UNION ALL SELECT 'paginas_cnpj', count(*) FROM c
UNION ALL SELECT 'paginas_lista', count(*) FROM c WHERE tipo = 'lista'
UNION ALL SELECT 'com_indice', count(page_idx) FROM c WHERE tipo = 'lista'
UNION ALL SELECT 'ultimo_indice', max(page_idx) FROM c WHERE tipo = 'lista'
UNION ALL SELECT 'processos', count(*) FROM rec""",
    "run_report": f"""WITH {_CASES}
SELECT k // 1000 AS batch_id, count(*) AS executions, count(CASE WHEN k % 12 = 0 THEN 1 END) AS successes,
       count(CASE WHEN k % 12 <> 0 THEN 1 END) AS failures, count(CASE WHEN k % 12 = 0 THEN 1 END) * 100 // count(*) AS success_pct
FROM o GROUP BY 1""",
    "idempotency_check": f"""WITH {_CASES}
SELECT npu AS _id, k % 3 + 1 AS n_applied, CASE WHEN status = 'O' THEN 1 ELSE 0 END::BIGINT AS n_insert,
       k % 3 + CASE WHEN status = 'O' THEN 0 ELSE 1 END AS n_update,
       CASE WHEN status = 'O' THEN 'insert' ELSE 'update' END AS first_action, status = 'O' AS idempotent
FROM o WHERE status IN ('F', 'O') AND k % 3 > 0""",
    "reprocess_report": f"""WITH {_MIXED},
u AS (SELECT kind, CASE WHEN tipo = 'detalhe' OR (tipo IS NULL AND page_class = 'detail') THEN 'd' END AS t FROM mixed WHERE html <> '')
SELECT count(*) AS processed, count(CASE WHEN t IS NULL OR kind IN (0, 8) THEN 1 END) AS succeeded,
       count(CASE WHEN t = 'd' AND kind NOT IN (0, 8) THEN 1 END) AS failed FROM u""",
    "reprocess_pages": f"WITH {_OFFLINE} SELECT {_RECORD_COLUMNS} FROM ext",
    "reprocess_delta": f"""WITH {_AGAIN}
SELECT {_RECORD_COLUMNS} FROM ext WHERE k % 2 = 1 UNION ALL SELECT {_RECORD_COLUMNS} FROM again WHERE k % 2 = 0""",
    "ingest_pages": f"""WITH {_ONLINE}
SELECT * REPLACE (
  CASE WHEN status IN ('F', 'P') AND k % 3 >= 1 THEN {_iso('k')} END AS reprocessed_at,
  CASE WHEN status IN ('F', 'P') THEN 'old' END AS reprocessed_from_doc) FROM (SELECT k, status, {_RECORD_COLUMNS} FROM ext)""",
    "stream_pages": f"WITH {_ONLINE} SELECT {_RECORD_COLUMNS} FROM ext",
    "stream_after_compact": f"""WITH {_AGAIN}
SELECT {_RECORD_COLUMNS} FROM ext WHERE k % 3 <> 2
UNION ALL SELECT {_RECORD_COLUMNS} FROM (SELECT * REPLACE ({_iso('k')} AS scraped_at) FROM again) WHERE k % 3 = 2""",
    "stream_health": _HEALTH_ROWS,
    "stream_health_transitions": _HEALTH_CHANGES,
    "stream_health_late": _HEALTH_ROWS,
    "stream_transitions_late": _HEALTH_CHANGES,
}
_ORACLE["ingest_pages"] = _ORACLE["ingest_pages"].replace("SELECT * REPLACE", "SELECT * EXCLUDE (k, status) REPLACE")


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
