"""DuckDB expression builders used by the SQL twins (strings only)."""

from __future__ import annotations

from ..operators.classify import (NEGATIVE_KEYWORDS, POSITIVE_KEYWORDS, SENSITIVE_WORDS,
                                  STOPWORDS)
from ..schema import CORE_LANGUAGES, NEGATIVE_ASPECTS, POSITIVE_ASPECTS
from .oracle import COLS

NL = "chr(10)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def blank(c: str) -> str:
    return f"({c} = '' OR {c} IS NULL)"


def nonblank(c: str) -> str:
    return f"(coalesce({c}, '') <> '')"


# Python's str.isspace set in RE2 syntax (RE2 has no \\u escapes).
_PY_WS_RE2 = ("\\t\\n\\x{0b}\\f\\r\\x{1c}-\\x{1f} \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
              "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}")


def strip_labels(portal: str = "Portal", text: str = "ReviewText") -> str:
    k = (f"regexp_replace(regexp_replace({text}, '([^{_PY_WS_RE2}]+) rating: [1-5]/5 ', '', 'g'),"
         f" '\\n{{2,}}', {NL}, 'g')")
    return (f"(CASE lower({portal}) WHEN 'indeed' THEN replace(replace({text}, 'Pros: ', ''), 'Cons: ', '')"
            f" WHEN 'kununu' THEN (CASE WHEN {k} = {NL} THEN '' ELSE {k} END) ELSE {text} END)")


def tokens(text: str) -> str:
    return (f"list_filter(regexp_split_to_array(lower(coalesce({text}, '')), '[^\\p{{L}}]+'),"
            " lambda t: t <> '')")


def count_in(toks: str, words: list[str]) -> str:
    return f"len(list_filter({toks}, lambda t: list_contains({sql_list(words)}, t)))"


def argmax(counts: list[tuple[str, str]], default: str) -> str:
    """Highest count wins, earlier label on ties, all zero -> default."""
    mx = "greatest(" + ", ".join(c for _, c in counts) + ")"
    cases = " ".join(f"WHEN {c} = {mx} THEN {q(lbl)}" for lbl, c in counts)
    return f"(CASE WHEN {mx} = 0 THEN {default} {cases} END)"


def language_of(text: str, default: str = "'Other'") -> str:
    toks = tokens(text)
    return argmax([(lang, count_in(toks, STOPWORDS[lang])) for lang in CORE_LANGUAGES], default)


def detect_language() -> str:
    return language_of(f"concat_ws({NL}, ReviewTitle, {strip_labels()})")


def aspects(kind: str) -> str:
    toks = tokens(strip_labels())
    if kind == "pos":
        pairs = [(a, count_in(toks, POSITIVE_KEYWORDS[a])) for a in POSITIVE_ASPECTS
                 if a in POSITIVE_KEYWORDS]
    else:
        pairs = [(a, count_in(toks, NEGATIVE_KEYWORDS[a])) for a in NEGATIVE_ASPECTS
                 if a in NEGATIVE_KEYWORDS]
    return argmax(pairs, "'Uncategorized'")


def sensitive(text: str) -> str:
    return (f"(CASE WHEN len(list_filter({tokens(text)}, lambda t: list_contains({sql_list(SENSITIVE_WORDS)}, t)))"
            " > 0 THEN 'Yes' ELSE 'No' END)")


def reply_language(lang: str = "Language", portal: str = "Portal") -> str:
    return (f"(CASE WHEN upper({lang}) IN {tuple(CORE_LANGUAGES)} THEN upper({lang})"
            f" WHEN lower({portal}) = 'kununu' THEN 'DE' ELSE 'EN' END)")


# -- answers ---------------------------------------------------------------

def has(k: str) -> str:
    return f"coalesce(list_contains(list_transform(json_keys(obj), lambda x: lower(x)), {q(k.lower())}), false)"


def get(k: str) -> str:
    return (f"json_extract_string(obj, '$.\"' || list_filter(json_keys(obj), lambda x: lower(x) = "
            f"{q(k.lower())})[-1] || '\"')")


def answer_obj(content: str) -> str:
    t = f"CASE WHEN contains({content}, '{{') THEN '{{' || regexp_extract({content}, '\\{{([^{{}}]*)', 1) || '}}' END"
    return f"CASE WHEN json_valid({t}) AND json_type({t}) = 'OBJECT' THEN {t} END"


def answer_content() -> str:
    clean = f"replace(replace(replace(text, '\"', ''), '\\', ''), {NL}, '\\n')"
    rkey = "CASE doc_id % 3 WHEN 0 THEN 'Response' WHEN 1 THEN 'response' ELSE 'RESPONSE' END"
    rval = f"CASE WHEN doc_id % 29 = 0 THEN '(Leer)' WHEN doc_id % 31 = 0 THEN '' ELSE {clean} END"
    ckey = "CASE WHEN doc_id % 2 = 0 THEN 'Country' ELSE 'country' END"
    pos = f"CASE WHEN doc_id % 53 = 0 THEN 'Great pizza' ELSE ({sql_list(POSITIVE_ASPECTS)})[1 + doc_id % 18] END"
    neg = f"({sql_list(NEGATIVE_ASPECTS)})[1 + (doc_id * 7) % 18]"
    sens = "CASE WHEN toxic = 1 THEN 'Yes' ELSE 'No' END"
    emp = "CASE WHEN doc_id % 23 = 0 THEN '\"n/a\"' ELSE CAST(1 + doc_id % 5 AS VARCHAR) END"
    hlp = ("CASE WHEN doc_id % 37 = 0 THEN '' ELSE ', \"HelpfulnessScore\": ' || "
           "CAST(1 + doc_id % 4 AS VARCHAR) END")
    ind = "CAST((doc_id * 3) % 7 AS VARCHAR)"
    obj = (f"'{{\"' || {rkey} || '\": \"' || {rval} || '\", \"StateRegion\": \"Region ' || "
           f"CAST(doc_id % 7 AS VARCHAR) || '\", \"' || {ckey} || '\": \"' || coalesce(n_name, '?') || "
           f"'\", \"MainPositiveAspect\": \"' || {pos} || '\", \"MainAreaOfImprovement\": \"' || {neg} || "
           f"'\", \"SensitiveTopic\": \"' || {sens} || '\", \"EmpathyScore\": ' || {emp} || {hlp} || "
           f"', \"IndividualityScore\": ' || {ind} || '}}'")
    return f"CASE WHEN doc_id % 19 = 0 THEN 'no object here' ELSE 'Sure: ' || {obj} || ' bye' END"


ANSWERS_CTE = (
    "answers AS (SELECT lower(portal) || '-' || CAST(doc_id AS VARCHAR) AS ID,"
    " CASE WHEN doc_id % 41 = 0 THEN 500 WHEN doc_id % 43 = 0 THEN 429 ELSE 200 END AS status,"
    f" {answer_content()} AS content FROM base)")


def row_select(overrides: dict[str, str]) -> str:
    """All table columns in order, with some replaced by expressions."""
    return ", ".join(f"{overrides[c]} AS {c}" if c in overrides else c
                     for c in [x.strip() for x in COLS.split(",")])


def reply_steps(asof: str) -> dict[str, str]:
    answered = "(_status IS NOT NULL)"
    failed = f"({answered} AND NOT (_status BETWEEN 200 AND 299))"
    ok = f"({answered} AND (_status BETWEEN 200 AND 299) AND obj IS NOT NULL)"
    regen = f"({ok} AND coalesce(ApprovalStatus, '') = 'Regenerate')"
    regen_ok = f"({regen} AND {has('Response')})"
    d = f"({ok} AND NOT {regen} AND {has('SensitiveTopic')})"
    loc = nonblank("Location")
    e_state = f"({d} AND {loc} AND {has('StateRegion')})"
    e_country = f"({e_state} AND {has('Country')})"
    after_e = f"({d} AND (NOT {loc} OR {e_country}))"
    resp = get("Response")
    f = f"({after_e} AND {has('Response')} AND {resp} <> '' AND NOT contains({resp}, '(Leer)'))"
    g = f"({f} AND {blank('Response')})"
    g_days = f"({g} AND ReviewDate IS NOT NULL)"
    g_pos = f"({g_days} AND {has('MainpositiveAspect')})"
    g_neg = f"({g_pos} AND {has('MainAreaofImprovement')})"
    h0 = f"({f} AND (NOT {blank('Response')} OR {g_neg}))"
    h1 = f"({h0} AND {has('EmpathyScore')})"
    h2 = f"({h1} AND {has('HelpfulnessScore')})"
    h3 = f"({h2} AND {has('IndividualityScore')})"
    unesc = f"replace({resp}, '\\n', {NL})"
    return {
        "Response": f"CASE WHEN {regen_ok} OR {g} THEN {unesc} ELSE Response END",
        "ApprovalStatus": f"CASE WHEN {regen_ok} OR {g_neg} THEN 'Pending' ELSE ApprovalStatus END",
        "SensitiveTopic": f"CASE WHEN {d} THEN {get('SensitiveTopic')} ELSE SensitiveTopic END",
        "StateRegion": f"CASE WHEN {e_state} THEN {get('StateRegion')} ELSE StateRegion END",
        "Country": f"CASE WHEN {e_country} THEN {get('Country')} ELSE Country END",
        "EstResponseDate": f"CASE WHEN {g} THEN {asof} ELSE EstResponseDate END",
        "ResponseTimeDays": (f"CASE WHEN {g_days} THEN CAST(datediff('day', ReviewDate, {asof}) AS INTEGER)"
                             " ELSE ResponseTimeDays END"),
        "MainpositiveAspect": f"CASE WHEN {g_pos} THEN {get('MainpositiveAspect')} ELSE MainpositiveAspect END",
        "MainAreaofImprovement": (f"CASE WHEN {g_neg} THEN {get('MainAreaofImprovement')}"
                                  " ELSE MainAreaofImprovement END"),
        "EmpathyScore": f"CASE WHEN {h1} THEN TRY_CAST({get('EmpathyScore')} AS DOUBLE) ELSE EmpathyScore END",
        "HelpfulnessScore": (f"CASE WHEN {h2} THEN TRY_CAST({get('HelpfulnessScore')} AS DOUBLE)"
                             " ELSE HelpfulnessScore END"),
        "IndividualityScore": (f"CASE WHEN {h3} THEN TRY_CAST({get('IndividualityScore')} AS DOUBLE)"
                               " ELSE IndividualityScore END"),
        "DeveloperComment": f"CASE WHEN {failed} THEN CAST(_status AS VARCHAR) ELSE DeveloperComment END",
    }


def completion_steps() -> dict[str, str]:
    answered = "(_status IS NOT NULL)"
    failed = f"({answered} AND NOT (_status BETWEEN 200 AND 299))"
    ok = f"({answered} AND (_status BETWEEN 200 AND 299) AND obj IS NOT NULL AND Response IS NOT NULL)"
    loc = nonblank("Location")
    s1 = f"({ok} AND (NOT {loc} OR {has('StateRegion')}))"
    state = f"({ok} AND {loc} AND {has('StateRegion')})"
    s2 = f"({s1} AND (NOT {loc} OR {has('Country')}))"
    country = f"({state} AND {has('Country')})"
    s3 = f"({s2} AND {has('SensitiveTopic')})"
    s4 = f"({s3} AND {has('MainpositiveAspect')})"
    s5 = f"({s4} AND {has('MainAreaofImprovement')})"
    emp, hlp, ind = (f"TRY_CAST({get(k)} AS DOUBLE)" for k in
                     ("EmpathyScore", "HelpfulnessScore", "IndividualityScore"))
    s6 = f"({s5} AND {has('EmpathyScore')} AND {emp} IS NOT NULL)"
    s7 = f"({s6} AND {has('HelpfulnessScore')} AND {hlp} IS NOT NULL)"
    s8 = f"({s7} AND {has('IndividualityScore')} AND {ind} IS NOT NULL)"
    return {
        "StateRegion": f"CASE WHEN {state} THEN {get('StateRegion')} ELSE StateRegion END",
        "Country": f"CASE WHEN {country} THEN {get('Country')} ELSE Country END",
        "SensitiveTopic": f"CASE WHEN {s3} THEN {get('SensitiveTopic')} ELSE SensitiveTopic END",
        "MainpositiveAspect": f"CASE WHEN {s4} THEN {get('MainpositiveAspect')} ELSE MainpositiveAspect END",
        "MainAreaofImprovement": (f"CASE WHEN {s5} THEN {get('MainAreaofImprovement')}"
                                  " ELSE MainAreaofImprovement END"),
        "EmpathyScore": f"CASE WHEN {s6} THEN {emp} ELSE EmpathyScore END",
        "HelpfulnessScore": f"CASE WHEN {s7} THEN {hlp} ELSE HelpfulnessScore END",
        "IndividualityScore": f"CASE WHEN {s8} THEN {ind} ELSE IndividualityScore END",
        "DeveloperComment": f"CASE WHEN {failed} THEN CAST(_status AS VARCHAR) ELSE DeveloperComment END",
    }
