"""Quality rules, line first, in DataFrame functions only.

Each line is held against three rules: it holds no boilerplate phrase, it
isn't a navigation bar, it ends like a sentence.  Phrases count as whole words,
in four languages; calls to act count in short lines alone, as prose uses them
too.  Lines that fail are removed, each named by the first rule it fails; a
document that loses too much of its text, or fails the base rules on the whole
text, is rejected.  One pass over the rows, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import BLANKS

# Fixed values of the line rules.
SENTENCE_ENDS = [".", "!", "?", "…", "\"", "'", "”", "’", "»", ")", "。", "！", "？", "।", "؟"]
SEPARATORS = "|»›•·"
SPACED_SEPARATORS = [" > ", " / "]
#: Boilerplate wherever it stands.
PHRASES = {
    "en": ["all rights reserved", "privacy policy", "cookie policy", "uses cookies", "accept cookies",
           "accept all cookies", "enable javascript", "javascript is disabled", "terms of use", "terms of service",
           "terms and conditions", "skip to content", "lorem ipsum"],
    "de": ["alle rechte vorbehalten", "datenschutzerklärung", "cookie-richtlinie", "verwendet cookies",
           "cookies akzeptieren", "javascript aktivieren", "nutzungsbedingungen", "allgemeine geschäftsbedingungen"],
    "fr": ["tous droits réservés", "politique de confidentialité", "utilise des cookies", "accepter les cookies",
           "activer javascript", "mentions légales", "conditions d'utilisation", "conditions générales de vente"],
    "es": ["todos los derechos reservados", "política de privacidad", "política de cookies", "utiliza cookies",
           "aceptar cookies", "aviso legal", "condiciones de uso", "términos y condiciones"],
}
#: Calls to act: boilerplate in a line of at most CALL_CHARS characters.
CALLS = {
    "en": ["click here", "read more", "sign in", "log in", "sign up", "subscribe", "share this", "cookies"],
    "de": ["hier klicken", "weiterlesen", "mehr erfahren", "anmelden", "registrieren", "abonnieren", "impressum"],
    "fr": ["cliquez ici", "lire la suite", "en savoir plus", "se connecter", "s'inscrire", "s'abonner"],
    "es": ["haga clic aquí", "haz clic aquí", "leer más", "más información", "iniciar sesión", "suscríbete",
           "regístrate"],
}
CALL_CHARS = 40
#: A navigation bar has two separators or more, and parts of at most so many characters, on average.
NAVIGATION_PART = 25
RULES = ["boilerplate", "navigation", "no_end"]
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST = 0.5


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _whole_words(phrases: dict[str, list[str]]) -> str:
    """A pattern that finds any of the phrases between characters that are neither letters nor digits."""
    found = "|".join(p for of_language in phrases.values() for p in of_language)
    return f"(^|[^\\p{{L}}\\p{{N}}])({found})([^\\p{{L}}\\p{{N}}]|$)"


def failed_rule(line: Column) -> Column:
    """The first of ``RULES`` that a line fails; null for a line that reads like a sentence, and for a blank one."""
    body, low = F.btrim(line, F.lit(BLANKS)), F.lower(line)
    phrase = F.rlike(low, F.lit(_whole_words(PHRASES))) | \
        ((F.length(body) <= CALL_CHARS) & F.rlike(low, F.lit(_whole_words(CALLS))))
    bars = F.length(line) - F.length(_without(line, SEPARATORS))
    for s in SPACED_SEPARATORS:
        bars = bars + F.length(line) - F.length(F.replace(line, F.lit(s), F.lit(" " * (len(s) - 1))))
    navigation = (bars >= 2) & (F.length(body) <= NAVIGATION_PART * (bars + 1))
    sentence = F.right(body, F.lit(1)).isin(SENTENCE_ENDS)
    return F.when(body == "", None).when(phrase, RULES[0]).when(navigation, RULES[1]).when(~sentence, RULES[2])


def judge_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    max_lost: float = MAX_LOST) -> DataFrame:
    """One row per row of ``docs``: counts on the whole text, cleaned text, verdict.

    A null text counts as empty: no words, so it fails the base rules; its
    cleaned text is null.  Ties and repeated rows are judged alike; an empty
    table gives an empty result.  Windows are compared by a 64-bit hash of
    their three words, within one text only.  ``n_<rule>`` counts the lines
    removed by each rule.  Other columns aren't read.
    """
    raw = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    d = d.select("doc_id", "text", F.array_remove(F.split(raw, "[\\x20\\x09-\\x0D]+"), "").alias("w"),
                 F.split(raw, "\n").alias("lines"))
    windows = F.transform(F.array("w"), lambda ws: F.transform(
        F.sequence(F.lit(0), F.size(ws) - 3),
        lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2))))[0]
    body = F.filter("lines", lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    d = d.select("doc_id", "text", "lines", F.size("w").alias("n_words"),
                 F.when(F.size("w") >= 3, windows).otherwise(F.array().cast("array<bigint>")).alias("h"),
                 body.alias("body"), F.transform("lines", lambda x: F.struct(x.alias("line"), failed_rule(x).alias("rule"))).alias("marked"))
    good = F.transform(F.filter("marked", lambda m: m["rule"].isNull()), lambda m: m["line"])
    d = d.select("*", good.alias("good"))
    # windows found again: equal neighbours among the sorted (hash, place) pairs
    pairs = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    again = F.transform(F.array(pairs), lambda s: F.transform(F.filter(
        F.sequence(F.lit(0), F.size(s) - 1),
        lambda j: (F.get(s, j)["h"] == F.get(s, j - 1)["h"]) | (F.get(s, j)["h"] == F.get(s, j + 1)["h"])),
        lambda j: F.get(s, j)["p"]))[0]
    covered = F.size(F.array_distinct(F.flatten(F.transform(again, lambda p: F.array(p, p + 1, p + 2)))))
    solid = _without(raw, BLANKS)

    def chars(lines: str) -> Column:
        return F.aggregate(lines, F.lit(0), lambda n, x: n + F.length(x))

    def failing(rule: str) -> Column:
        return F.size(F.filter("marked", lambda m: m["rule"] == rule))

    d = d.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"),
        F.length(solid).cast("long").alias("word_chars"),
        (F.octet_length(raw) - F.octet_length(_without(raw, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("body") - F.size(F.array_distinct("body"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("h")) < F.size("h"), covered).otherwise(0).cast("long")
        .alias("n_repeat_words"),
        (F.size("lines") - F.size("good")).cast("long").alias("n_bad_lines"),
        *[failing(r).cast("long").alias(f"n_{r}") for r in RULES],
        chars("lines").cast("long").alias("line_chars"), chars("good").cast("long").alias("good_chars"),
        F.when(F.col("text").isNotNull(), F.array_join("good", "\n")).alias("clean_text"))
    failed = (F.col("n_words") < MIN_WORDS) | \
        (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    lost = F.when(F.col("line_chars") > 0, 1 - F.col("good_chars") / F.col("line_chars")).otherwise(0.0)
    return d.withColumns({"lost": lost, "base_failed": failed}) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("lost") <= max_lost))


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_BODY_SQL = f"trim(x, {_BLANKS_SQL})"
_BARS_SQL = f"(length(x) - length(regexp_replace(x, '[{SEPARATORS}]', '', 'g')){''.join(
    f" + length(x) - length(replace(x, '{s}', '{' ' * (len(s) - 1)}'))" for s in SPACED_SEPARATORS)})"
_RULE_SQL = f"""CASE WHEN {_BODY_SQL} = '' THEN NULL
  WHEN regexp_matches(lower(x), {_sql_text(_whole_words(PHRASES))})
    OR length({_BODY_SQL}) <= {CALL_CHARS} AND regexp_matches(lower(x), {_sql_text(_whole_words(CALLS))}) THEN '{RULES[0]}'
  WHEN {_BARS_SQL} >= 2 AND length({_BODY_SQL}) <= {NAVIGATION_PART} * ({_BARS_SQL} + 1) THEN '{RULES[1]}'
  WHEN right({_BODY_SQL}, 1) NOT IN ({', '.join(map(_sql_text, SENTENCE_ENDS))}) THEN '{RULES[2]}' END"""
#: DuckDB's words for the columns that the query returns.
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
             string_split(t, chr(10)) AS ls FROM d),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS p, w FROM w WHERE len(w) >= 3),
h AS (SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS win FROM g),
r AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, win) AS n FROM h),
c AS (SELECT doc_id, count(DISTINCT q) AS n FROM (
        SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM r WHERE n > 1) GROUP BY doc_id),
a AS (SELECT w.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
        list_filter(ls, lambda x: trim(x, {_BLANKS_SQL}) <> '') AS body, coalesce(c.n, 0) AS n_repeat_words,
        list_transform(ls, lambda x: {_RULE_SQL}) AS rules, ls
      FROM w LEFT JOIN c ON c.doc_id = w.doc_id),
f AS (SELECT doc_id, n_words, word_chars, n_symbols, len(body) - len(list_distinct(body)) AS n_dup_lines,
        n_repeat_words, {', '.join(f"len(list_filter(rules, lambda r: r = '{r}')) AS n_{r}" for r in RULES)},
        list_transform(range(1, len(ls) + 1), lambda i: CASE WHEN rules[i] IS NULL THEN length(ls[i]) ELSE 0 END) AS good,
        coalesce(list_sum(list_transform(ls, lambda x: length(x))), 0) AS line_chars,
        coalesce(list_sum(good), 0) AS good_chars,
        n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM a)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST({' + '.join(f'n_{r}' for r in RULES)} AS BIGINT) AS n_bad_lines,
  {', '.join(f'CAST(n_{r} AS BIGINT) AS n_{r}' for r in RULES)}, base_failed,
  NOT base_failed AND (CASE WHEN line_chars > 0 THEN 1 - good_chars / line_chars ELSE 0 END) <= {MAX_LOST} AS kept
FROM f
"""
