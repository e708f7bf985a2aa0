"""Patterns, phrases, limits and names the data model depends on.

Every literal here is a fixed value: results must be the same as those of the
crawler whose pages we process, so the values keep their texts and their order.
Patterns matched on upper-cased pages are in upper case, navigation texts are the
link texts alone, and counts before a word are possessive, which matches the same.
``functions.text.rx`` adapts the patterns to Java regex (unicode whitespace).
"""

# --- fixed values: identifiers -------------------------------------------------
NPU = r"\d{7}-\d{2}\.\d{4}\.\d\.\d{2}\.\d{4}"
NUMBER_CLASSES = ["processo-numero", "numero-processo"]
LEGACY_NUMBER = r"\(([0-9]{2}\.[0-9]{2}\.[0-9]+-[0-9])\)"
NPU_DIGITS = 20
CNPJ_DIGITS = 14

# --- fixed values: dates -------------------------------------------------------
DATE_TIME_PREFIX = r"^(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{1,2})"
DATE_PREFIX = r"^(\d{1,2})/(\d{1,2})/(\d{4})"
DATE_ANYWHERE = r"\d{1,2}/\d{1,2}/\d{4}"
FILED_ON = r"AUTUADO\s+EM\s+(\d{1,2}/\d{1,2}/\d{4})"
FILED_ON_NODE_MARKS = ["Autuação", "Data:"]
FILED_ON_CLASSES = ["data-autuacao", "autuacao"]
MOVEMENT_DATE = r"Em\s+(\d{1,2}/\d{1,2}/\d{4}\s+\d{1,2}:\d{1,2})"

# --- fixed values: judge titles, removed in this order, each once ---------------
JUDGE_TITLES = [
    r"^\s*Des\.?\s+",
    r"^\s*DESEMBARGADOR(A)?\s+FEDERAL\s+",
    r"^\s*DESEMBARGADOR(A)?\s+",
    r"^\s*JUIZ(A)?\s+FEDERAL\s+",
    r"^\s*JUIZ(A)?\s+",
    r"^\s*DR\.?\s+",
    r"^\s*DRA\.?\s+",
]
TITLE_LEFT = r"^(Des\.|DESEMBARGADOR|JUIZ)"

# --- fixed values: where a judge is named ---------------------------------------
JUDGE_CELL_TAGS = ["b", "strong", "span"]
JUDGE_CLASSES_FIRST = ["relator", "magistrado", "juiz", "desembargador"]
JUDGE_CLASSES_LAST = ["info-relator", "dados-relator"]
JUDGE_LABEL = r"relator:?\s*(.+)"
JUDGE_TEXT = [
    r"RELATOR:?\s*([^\n\r<]+)",
    r"Relator:?\s*([^\n\r<]+)",
    r"DESEMBARGADOR(?:\s+FEDERAL)?:?\s*([^\n\r<]+)",
    r"JUIZ(?:A)?\s+FEDERAL:?\s*([^\n\r<]+)",
    r"(?:RELATOR|RELATORA)\s*-\s*([^\n\r<]+)",
]

# --- fixed values: movements ----------------------------------------------------
RECEIPT_TAIL = r"\[Guia:.*?\].*"
MOVEMENT_SECTIONS = ["movimentacoes", "andamentos", "timeline"]
MOVEMENT_ITEMS = ["movimento", "andamento", "item"]
MOVEMENT_DATE_CLASSES = ["data", "timestamp"]
MOVEMENT_TEXT_CLASSES = ["texto", "descricao"]

# --- fixed values: page signals (matched on upper-cased text) --------------------
CASE_HEADER = r"PROCESSO\s+N[°ºoO]"
PARTY_WORDS = [
    r"APT[EO]",
    r"APD[AO]",
    r"AUTOR",
    r"R[EÉ]U",
    r"ADVOGAD[AO]",
    r"PROCURADOR",
    r"PART[EI]",
]
PARTY_WORDS_WIDE = PARTY_WORDS + [r"ENVOLVIDOS?"]
TIMELINE_WORDS = [
    r"MOVIMENTA[ÇC][ÃA]O",
    r"MOVIMENTOS?",
    r"ANDAMENTOS?",
    r"\d{1,2}/\d{1,2}/\d{4}",
    r"PETICIONAMENTO",
    r"JUNTADA",
    r"PUBLICA[ÇC][ÃA]O",
    r"AUTUAD[AO]\s+EM",
]
JUDGE_WORDS = [r"RELATOR", r"DESEMBARGADOR", r"JUIZ(A)?\s+FEDERAL"]
TOTAL_MARK = r"TOTAL:\s*\d+"
PAGER_WORDS = [
    r"PR[ÓO]XIMA",
    r"[ÚU]LTIMA",
    r"PRIMEIRA",
    r"ANTERIOR",
    r"P[ÁA]GINA\s*\d+",
    r">\s*\d+\s*<",
]
TABLE_TAGS = ["TABLE", "TBODY", "TR"]
ERROR_WORDS = [
    r"NENHUM\s+RESULTADO",
    r"N[ÃA]O\s+FORAM?\s+ENCONTRADOS?",
    r"RESULTADO\s+N[ÃA]O\s+ENCONTRADO",
    r"SEM\s+RESULTADOS?",
    r"BUSCA\s+SEM\s+RETORNO",
    r"CONSULTA\s+SEM\s+RESULTADO",
    r"ERRO\s+\d+",
    r"P[ÁA]GINA\s+N[ÃA]O\s+ENCONTRADA",
    r"ACESSO\s+NEGADO",
    r"SERVI[ÇC]O\s+INDISPON[ÍI]VEL",
    r"SISTEMA\s+FORA\s+DO\s+AR",
    r"MANUTEN[ÇC][ÃA]O",
]
MIN_PAGE_CHARS = 100
STABLE_INVALID = "O NÚMERO DO PROCESSO INFORMADO NÃO É VÁLIDO"
STABLE_RESULTS = "consulta_resultados"
STABLE_TAX_ID_HEADER = r"<th[^>]*>\s*CNPJ\s*:?\s*</th>"

# --- fixed values: indicators reported for pages that are not details -------------
PARTY_INDICATORS = ["AUTOR", "REU", "RÉU", "ADVOGADO"]
TIMELINE_INDICATORS = ["MOVIMENTAÇÃO", "ANDAMENTO", "JUNTADA"]

# --- fixed values: totals and pagination ------------------------------------------
TOTAL_PATTERNS = [
    r"Total:\s*(\d+)",
    r"Total\s+de\s+(\d+)",
    r"(?<!\d)(\d++)\s+resultados?",
    r"(?<!\d)(\d++)\s+processos?",
    r"Encontrados?\s+(\d+)",
    r"Localizado[s]?\s+(\d+)",
]
NAV_TEXT = {
    "next": [r"pr[óo]xima?", r"seguinte", r">"],
    "last": [r"[úu]ltima?", r"fim", r">>"],
    "first": [r"primeira?", r"in[íi]cio", r"<<"],
    "prev": [r"anterior", r"<"],
}
PAGE_PARAM = r"page[=](\d+)"
STABLE_NEXT_WORDS = ["próxima", "next", "seguinte"]
STABLE_FREE_PAGES = 5
PAGE_SIZE = 10
DEFAULT_MAX_PAGES, CAP_MAX_PAGES = 5, 20
DEFAULT_MAX_DETAILS, CAP_MAX_DETAILS = 10, 50

# --- fixed values: best-link scores ------------------------------------------------
SCORE_EXACT, SCORE_NPU, SCORE_DETAIL_PATH, SCORE_NO_QUERY = 100, 50, 25, 10

# --- fixed values: form search ------------------------------------------------------
FORM_TYPE_FIELD, FORM_VALUE_FIELD = "tipo", "filtro"
FORM_TYPE = {"numero": "xmlproc", "cnpj": "xmlcpf"}

# --- fixed values: store rules --------------------------------------------------------
ISO_SECONDS = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"
ISO_DATE_OR_SECONDS = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2})?$"
ISO_DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}"
HASH = r"^sha256:[a-f0-9]{64}$"
PAGE_TYPES = ["lista", "detalhe", "form", "erro"]
SEARCH_MODES = ["numero", "cnpj"]
METHODS = ["GET", "POST"]

# --- fixed values: fetch health and retry -----------------------------------------------
RETRY_STATUS = [500, 502, 503, 504, 408, 429]
FAILURE_PHRASES = [
    "erro interno do servidor",
    "sistema temporariamente indisponível",
    "manutenção programada",
    "service unavailable",
    "gateway timeout",
    "connection timed out",
    "erro 5",
    "página não encontrada",
    "acesso negado",
]
MIN_BODY_CHARS, MIN_TEXT_CHARS = 100, 50
RETRYABLE_EXCEPTIONS = [
    "TimeoutError",
    "ConnectionError",
    "ConnectTimeout",
    "ReadTimeout",
    "DNSLookupError",
    "TunnelError",
    "TCPTimedOutError",
]
HEALTH_RECENT, HEALTH_MIN_EVENTS, HEALTH_SAMPLE = 20, 10, 100
HEALTH_MAX_RATE, HEALTH_MAX_CONSECUTIVE, HEALTH_MAX_SILENCE_SEC = 0.5, 5, 300
RETRY_DEFAULT_MAX = 5
BACKOFF_BASE, BACKOFF_MULTIPLIER, BACKOFF_CAP = 1.0, 2.0, 60.0
JITTER_LOW, JITTER_HIGH, DEGRADED_FACTOR = 0.5, 1.5, 2.0
TIMEOUT_SEC, TIMEOUT_CAP = 30.0, 120.0
# endpoint -> (allowed retries, delay multiplier, timeout multiplier)
ENDPOINTS = {
    "form": (3, 1.5, 1.2),
    "detail": (4, 1.0, 1.0),
    "list": (5, 2.0, 1.5),
    "stable_route": (6, 0.8, 0.9),
}
