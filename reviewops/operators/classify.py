r"""Set-based replacements for per-row model calls: language, place, aspect
categories, sensitive flag, rubric floors, plus the validity checks.

Token-count operators are row-local: a "token" is a maximal run of letters
of the lower-cased text, and a category count is the number of tokens in a
small literal word list, computed with compiled regexes on the JVM
(``(?<!\p{L})(?:w1|w2|...)(?!\p{L})``): one pass over the whole text collects
the hits of all lists, and the per-list counts run over those hits.  No explode, join or shuffle is
needed, so a review cannot skew a task by being long or common, and whole
texts are always used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_or_null, nonblank, strip_labels
from ..schema import CORE_LANGUAGES, NEGATIVE_ASPECTS, POSITIVE_ASPECTS
from .hotkeys import hot_keys, join_splitting_hot_keys


# Distinctive function words per core language (each word in
# one list only).  Order of languages = tie-break order.
STOPWORDS: dict[str, list[str]] = {
    "DE": ["der", "die", "das", "und", "den", "sich", "nicht", "ist", "ein", "eine", "mit",
           "von", "zu", "für", "auch", "auf", "dem", "ich", "wir"],
    "EN": ["the", "and", "of", "is", "to", "with", "this", "that", "from", "for", "by", "are",
           "was", "it", "be", "as", "on"],
    "NL": ["het", "een", "niet", "zijn", "ook", "maar", "voor", "dat", "wij", "bij", "naar",
           "heb", "wordt"],
    "IT": ["il", "gli", "della", "sono", "nel", "alla", "anche", "perché", "questo", "non",
           "per", "di", "che"],
    "ES": ["el", "los", "las", "y", "para", "con", "por", "una", "del", "es", "se", "no", "lo",
           "como", "más"],
    "FR": ["le", "les", "des", "du", "et", "une", "qui", "pour", "dans", "sur", "est", "avec",
           "pas", "au", "aux", "ce", "la"],
    "PT": ["os", "um", "uma", "não", "são", "também", "muito", "pelo", "pela", "ao"],
}

# Keywords per aspect category (lower case tokens; several
# languages).  Categories without keywords can only be reached by a model.
POSITIVE_KEYWORDS: dict[str, list[str]] = {
    "Career advancement": ["career", "promotion", "karriere", "aufstieg", "carrière"],
    "Good / stable job": ["stable", "secure", "sicher", "sicherer", "stabil"],
    "Superiors": ["manager", "boss", "chef", "vorgesetzte", "supervisor"],
    "Positive atmosphere": ["atmosphere", "friendly", "atmosphäre", "klima", "ambiance"],
    "Regular salary": ["punctual", "pünktlich", "regular"],
    "Colleagues": ["colleagues", "team", "kollegen", "collègues", "compañeros"],
    "Big company benefits": ["benefits", "discounts", "vorteile", "pension"],
    "Fair / good salary": ["salary", "pay", "gehalt", "salaire", "salario", "wage"],
    "No stress": ["relaxed", "calm", "entspannt", "ruhig"],
    "Trust / autonomous work": ["trust", "autonomy", "vertrauen", "independent"],
    "Professional development": ["training", "learning", "weiterbildung", "formation"],
    "Flexibility / Work-life balance": ["flexible", "balance", "homeoffice", "remote"],
    "Collaboration": ["collaboration", "teamwork", "zusammenarbeit"],
    "Good organization": ["organized", "organised", "organisation", "organization"],
    "Transparency": ["transparent", "transparency", "transparenz"],
    "Communication": ["communication", "kommunikation", "informed"],
}
NEGATIVE_KEYWORDS: dict[str, list[str]] = {
    "Poor Salary": ["underpaid", "unterbezahlt", "lowpaid"],
    "Hard work / workload": ["workload", "overtime", "überstunden", "stress", "exhausting"],
    "Boring tasks": ["boring", "monotonous", "langweilig", "eintönig"],
    "Old office / working place": ["office", "building", "büro", "gebäude"],
    "Big company disadvantages": ["bureaucracy", "bürokratie", "corporate"],
    "Intransparency": ["intransparent", "opaque", "secretive"],
    "Bad organization": ["chaos", "chaotic", "disorganized", "chaotisch"],
    "Contract / working conditions": ["contract", "vertrag", "befristet", "temporary"],
    "Old equipment / vehicles": ["equipment", "vehicles", "fahrzeuge", "ausstattung"],
    "Not enough manpower": ["understaffed", "personalmangel", "shortage"],
}

# Words marking a review as a sensitive topic (discrimination,
# harassment, insults), matched as whole lower-case tokens.
SENSITIVE_WORDS = [
    "racism", "racist", "sexism", "sexist", "harassment", "harassed", "discrimination",
    "rassismus", "rassistisch", "sexismus", "belästigung", "diskriminierung", "beleidigung",
    "racisme", "harcèlement", "racismo", "acoso",
    "idiot", "stupid", "moron", "scum", "loser", "pathetic", "disgusting", "worthless", "trash",
    "clown", "dumm", "arschloch",
]

# Greetings that lift a short reply above the empathy floor.
GREETING_PATTERN = (r"(?i)^\s*(hallo|hello|hi|dear|liebe|lieber|sehr geehrte|guten tag|bonjour|"
                    r"hola|ciao|beste|olá)\b")
SHORT_REPLY_CHARS = 200
# Rubric: a reply line counts as a standard block when it is at least this
# long and occurs in at least BLOCK_MIN_REPLIES distinct replies.
BLOCK_MIN_CHARS = 20
BLOCK_MIN_REPLIES = 2


def _esc(w: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in w)


def _prefix_alternation(words: list[str]) -> str:
    """Alternation over ``words`` factored by common prefixes (``the|this|to``
    -> ``t(?:h(?:e|is)|o)``): the same set of strings, but at each position
    only the branches of the letters actually read are tried."""
    root: dict = {}
    for w in set(words):
        node = root
        for ch in w:
            node = node.setdefault(ch, {})
        node[None] = {}

    def build(node: dict) -> str:
        end = None in node
        alts = [_esc(ch) + build(node[ch]) for ch in sorted(k for k in node if k is not None)]
        if not alts:
            return ""
        body = alts[0] if (len(alts) == 1 and not end) else "(?:" + "|".join(alts) + ")"
        return body + ("?" if end else "")

    return build(root)


def word_pattern(words: list[str]) -> str:
    """Regex matching exactly the tokens (maximal letter runs) in ``words``.
    A first-letter look-ahead makes most positions fail on one class test;
    the word alternation is prefix-factored."""
    first = "".join(sorted({_esc(w[0]) for w in words}))
    return f"(?=[{first}])(?<!\\p{{L}})(?:{_prefix_alternation(words)})(?!\\p{{L}})"


def _lower(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def count_words(lower_text: Column, words: list[str]) -> Column:
    """Number of tokens of an already lower-cased text that are in ``words``:
    one compiled-regex pass on the JVM, no per-token lambda."""
    return F.size(F.regexp_extract_all(lower_text, F.lit(word_pattern(words)), 0))


def _matches(lower_text: Column, words: list[str]) -> Column:
    return F.regexp_extract_all(lower_text, F.lit(word_pattern(words)), 0)


def _count_in(hits: Column, words: list[str]) -> Column:
    """Count within a (small) array of matched words."""
    lit = F.array(*[F.lit(w) for w in words])
    return F.size(F.filter(hits, lambda t: F.array_contains(lit, t)))


def _argmax(counts: list[tuple[str, Column]], default: Column) -> Column:
    """Label with the highest count; ties -> earlier label; all zero -> default."""
    best = F.greatest(*[F.struct(c.alias("n"), F.lit(-i).alias("o"), F.lit(lbl).alias("l"))
                        for i, (lbl, c) in enumerate(counts)])
    return F.when(best["n"] > 0, best["l"]).otherwise(default)


ALL_STOPWORDS = [w for lang in CORE_LANGUAGES for w in STOPWORDS[lang]]


def stopword_hits(text: Column) -> Column:
    """The stop-word tokens of a text, space-joined: one regex pass over the
    whole text.  Every language's words are in the union, so counting a
    language over this short string equals counting it over the text."""
    return F.array_join(_matches(_lower(text), ALL_STOPWORDS), " ")


def _language_counts(hits: Column) -> list[tuple[str, Column]]:
    return [(lang, count_words(hits, STOPWORDS[lang])) for lang in CORE_LANGUAGES]


def detect_language(df: DataFrame, place_language: DataFrame | None = None) -> DataFrame:
    """Adds ``detected_lang`` (a core code or ``Other``).

    Counts stop words of each core language in title + label-stripped text;
    the largest count wins.  With no hit the place decides (``place_language``:
    ``Location, lang``; joined without a forced broadcast, AQE broadcasts it
    when its measured size is small); without a place, ``Other``.
    """
    text = F.concat_ws("\n", F.col("ReviewTitle"), strip_labels(F.col("Portal"), F.col("ReviewText")))
    # the hits get their own projection, so the full-text pass runs once
    out = df.withColumn("_stop_hits", stopword_hits(text)).withColumn(
        "_lang_hit", _argmax(_language_counts(F.col("_stop_hits")), F.lit(None).cast("string"))
    ).drop("_stop_hits")
    if place_language is not None:
        pl = place_language.groupBy(F.col("Location").alias("_loc")).agg(
            F.min("lang").alias("_place_lang"))
        # only undecided rows with a place can match; the others are spread
        key = F.when(F.col("_lang_hit").isNull() & nonblank(F.col("Location")), F.col("Location")) \
            .otherwise(F.concat(F.lit("\u0000"), F.xxhash64("ID").cast("string")))
        out = out.join(pl, key == pl["_loc"], "left").drop("_loc")
        fallback = F.coalesce(F.col("_place_lang"), F.lit("Other"))
    else:
        fallback = F.lit("Other")
    out = out.withColumn("detected_lang", F.coalesce(F.col("_lang_hit"), fallback))
    return out.drop("_lang_hit", "_place_lang") if place_language is not None \
        else out.drop("_lang_hit")


def text_language(text: Column) -> Column:
    """Language of a bare string (used to verify translations)."""
    return _argmax(_language_counts(stopword_hits(text)), F.lit("Other"))


def fill_language(df: DataFrame) -> DataFrame:
    """Stored Language wins; else the detected code, upper case."""
    return df.withColumn("Language", F.coalesce(F.col("Language"), F.upper(F.col("detected_lang"))))


def reply_language(language: Column, portal: Column) -> Column:
    """Language a reply is written in: a core language as is, otherwise German
    on kununu and English elsewhere."""
    up = F.upper(language)
    return F.when(up.isin(CORE_LANGUAGES), up) \
        .when(F.lower(portal) == "kununu", F.lit("DE")).otherwise(F.lit("EN"))


def geo_enrich(df: DataFrame, places: DataFrame) -> DataFrame:
    """Location -> StateRegion, Country for rows with a Location.

    ``places`` (``place, state_region, country``) is a place dimension.  It
    is not force-broadcast: AQE broadcasts it when its measured size is below
    the threshold and shuffles otherwise.  Rows without a match keep their
    values.  A place listed twice counts once (its smallest entry), so no
    review is doubled; rows without a Location join on keys of their own that
    match nothing, so they are spread over all tasks; a big city is a skewed
    key of a plain join, which AQE splits.
    """
    p = (places.groupBy(F.col("place").alias("_place"))
         .agg(F.min(F.struct(F.col("state_region").alias("sr"), F.col("country").alias("co"))).alias("_p"))
         .select("_place", F.col("_p.sr").alias("_sr"), F.col("_p.co").alias("_co")))
    key = F.when(nonblank(F.col("Location")), F.col("Location")).otherwise(
        F.concat(F.lit("\u0000"), F.xxhash64("ID").cast("string")))
    j = df.join(p, key == p["_place"], "left")
    has_loc = nonblank(F.col("Location")) & F.col("_place").isNotNull()
    return j.select(*[
        F.when(has_loc, F.col("_sr")).otherwise(F.col(c)).alias(c) if c == "StateRegion" else
        F.when(has_loc, F.col("_co")).otherwise(F.col(c)).alias(c) if c == "Country" else
        F.col(c) for c in df.columns])


def places_from_nation(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Place dimension from the nation/region tables (25 rows, fixed)."""
    return (nation.join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"])
            .select(F.col("n_name").alias("place"), F.col("r_name").alias("state_region"),
                    F.col("n_name").alias("country")))


def classify_aspects(df: DataFrame) -> DataFrame:
    """Best positive and negative category by keyword count in the review
    text; ``Uncategorized`` when nothing matches (adds ``pos_aspect``,
    ``neg_aspect``).

    One regex pass per kind collects every keyword hit into a column (kept in
    its own projection, so it is computed once); the per-category counts then
    run over that short array only."""
    low = _lower(strip_labels(F.col("Portal"), F.col("ReviewText")))
    all_pos = [w for ws in POSITIVE_KEYWORDS.values() for w in ws]
    all_neg = [w for ws in NEGATIVE_KEYWORDS.values() for w in ws]
    hits = df.withColumn("_pos_hits", _matches(low, all_pos)) \
             .withColumn("_neg_hits", _matches(low, all_neg))
    pos = [(a, _count_in(F.col("_pos_hits"), POSITIVE_KEYWORDS[a])) for a in POSITIVE_ASPECTS
           if a in POSITIVE_KEYWORDS]
    neg = [(a, _count_in(F.col("_neg_hits"), NEGATIVE_KEYWORDS[a])) for a in NEGATIVE_ASPECTS
           if a in NEGATIVE_KEYWORDS]
    return hits.withColumn("pos_aspect", _argmax(pos, F.lit("Uncategorized"))) \
               .withColumn("neg_aspect", _argmax(neg, F.lit("Uncategorized"))) \
               .drop("_pos_hits", "_neg_hits")


def validate_aspects(df: DataFrame) -> DataFrame:
    """Rows whose stored aspect is not in the closed list for its kind."""
    checks = F.array(
        F.struct(F.lit("MainpositiveAspect").alias("column"), F.col("MainpositiveAspect").alias("value"),
                 F.col("MainpositiveAspect").isin(POSITIVE_ASPECTS).alias("ok")),
        F.struct(F.lit("MainAreaofImprovement").alias("column"),
                 F.col("MainAreaofImprovement").alias("value"),
                 F.col("MainAreaofImprovement").isin(NEGATIVE_ASPECTS).alias("ok")))
    bad = F.filter(checks, lambda s: s["value"].isNotNull() & ~s["ok"])
    return df.select("ID", F.inline(bad)).drop("ok")


def sensitive_flag(text: Column) -> Column:
    """``Yes`` when any sensitive word occurs as a token, else ``No``."""
    return F.when(_lower(text).rlike(word_pattern(SENSITIVE_WORDS)), F.lit("Yes")) \
        .otherwise(F.lit("No"))


SCORE_COLUMNS = ["EmpathyScore", "HelpfulnessScore", "IndividualityScore"]


def score_range_check(df: DataFrame) -> DataFrame:
    """Scores that are missing-but-expected are not flagged; present scores
    must be numbers in 1..5."""
    checks = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                       for c in SCORE_COLUMNS])
    bad = F.filter(checks, lambda s: s["value"].isNotNull() & ~s["value"].between(1, 5))
    return df.select("ID", F.inline(bad))


def empathy_floor(reply: Column) -> Column:
    """Computable part of the empathy rubric: 1 = no reply, 2 = very short
    reply without a greeting, else NULL (a judgment left to the model)."""
    return (F.when(blank_or_null(reply), F.lit(1.0))
            .when((F.length(reply) < SHORT_REPLY_CHARS) & ~reply.rlike(GREETING_PATTERN), F.lit(2.0)))


def individuality_score(df: DataFrame, reply_col: str = "Response",
                        min_chars: int = BLOCK_MIN_CHARS,
                        min_replies: int = BLOCK_MIN_REPLIES) -> DataFrame:
    """Computable individuality rubric per row (``ID, individuality``).

    1 = blank, ``(Leer)``, or the same reply text used for another review;
    else by the number of standard blocks (reply lines of at least
    ``min_chars`` that occur in at least ``min_replies`` distinct replies):
    >=5 -> 2, 3-4 -> 3, 2 -> 4, <=1 -> 5.

    Shape: the replies are read once and reduced to hashes -- the reply's SHA-256,
    the ``(Leer)`` flag and the SHA-256 of each distinct line -- which are staged
    under ``spark.checkpoint.dir``; no text crosses a shuffle.  Uses per reply and
    distinct replies per line are partially aggregated counts, so a reply or a
    boiler-plate line shared by a third of all rows is pre-combined in every
    task.  A reply used twice has its score already: only replies used once look
    up their lines.  Both join-backs broadcast the hot keys (at most
    HOT_KEY_BOUND of them) and shuffle only the rest.
    """
    r = F.col(reply_col)
    base = df.select("ID", r.alias("_reply"))
    long_lines = F.array_distinct(F.filter(
        F.transform(F.split(F.col("_reply"), "\n"), lambda x: F.trim(x)),
        lambda x: F.length(x) >= min_chars))
    texts = base.filter(nonblank(F.col("_reply"))).select(
        "ID", F.sha2(F.col("_reply"), 256).alias("_h"),
        F.col("_reply").contains("(Leer)").alias("_empty_mark"),
        F.transform(long_lines, lambda x: F.unhex(F.sha2(x, 256))).alias("_lks")).checkpoint()
    keyed = texts.select("ID", "_h", "_empty_mark")
    dup = keyed.groupBy("_h").agg(F.count(F.lit(1)).alias("_uses"))
    hot_h = hot_keys(dup, "_h", "_uses", keyed.agg(F.count(F.lit(1))).scalar())
    with_uses = join_splitting_hot_keys(keyed, dup, "_h", "inner", hot_h)
    # equal replies have equal lines: one row per distinct reply
    lines = texts.groupBy("_h").agg(F.first("_lks").alias("_lks")).select("_h", F.explode("_lks").alias("_lk"))
    per_line = lines.groupBy("_lk").agg(F.count(F.lit(1)).alias("_n"))
    hot_lk = hot_keys(per_line, "_lk", "_n", lines.agg(F.count(F.lit(1))).scalar())
    block_lines = per_line.filter(F.col("_n") >= min_replies).select("_lk")
    blocks = join_splitting_hot_keys(lines, block_lines, "_lk", "left_semi", hot_lk) \
        .groupBy("_h").agg(F.count(F.lit(1)).alias("_blocks"))
    once = with_uses.filter("_uses = 1").join(blocks, "_h", "left")
    often = with_uses.filter("_uses > 1").withColumn("_blocks", F.lit(None).cast("long"))
    scored = once.unionByName(often).select(
        "ID",
        F.when(F.col("_empty_mark") | (F.col("_uses") > 1), F.lit(1.0))
        .when(F.coalesce(F.col("_blocks"), F.lit(0)) >= 5, F.lit(2.0))
        .when(F.col("_blocks") >= 3, F.lit(3.0))
        .when(F.col("_blocks") == 2, F.lit(4.0))
        .otherwise(F.lit(5.0)).alias("individuality"))
    blank = base.filter(blank_or_null(F.col("_reply"))).select("ID", F.lit(1.0).alias("individuality"))
    return scored.unionByName(blank)
