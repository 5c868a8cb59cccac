"""Quality of texts by weak supervision, in DataFrame functions only.

Nine rules look at a text and vote for it (1), against it (0) or abstain (null). No rule decides alone:
expectation-maximisation estimates from the votes of all texts, without any label, how often each rule
is right about good and about bad texts, and every text gets the probability that it is good.

A rule of a text is a few numbers; they are taken inside the row, so nothing is shuffled but the votes,
and those are counted per pattern first. There are at most 3**9 patterns, whatever the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowatch.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
NO_LETTER = r"[\x20\x09-\x0D][^\x20\x09-\x0D\p{L}]++(?![^\x20\x09-\x0D])"  # a word without letters and the space before it
SENTENCE_LINE = r"[.!?][\x20\x09\x0B-\x0D]*(?=\n|\z)"  # a line that ends a sentence
WINDOW = 8  # words of a window that may be repeated
MIN_WORDS = 20
MAX_REPEATED = 30  # percent of the words
ROUNDS = 25

# Measure, and the values up to or from which a rule votes: (name, against below, for from, for up to, against above).
RULES = [
    ("length", 20, 50, None, None),  # words
    ("word_length", 3.5, 4.0, 7.0, 7.5),  # characters a word
    ("symbols", None, None, 0.05, 0.1),  # symbols a word
    ("duplicate_lines", None, None, 0.1, 0.3),  # share of the lines
    ("repeats", None, None, 0.05, 0.2),  # share of the words
    ("letters", 0.8, 0.95, None, None),  # share of words with a letter
    ("sentences", 0.5, 0.8, None, None),  # share of lines that end a sentence
    ("capitals", None, None, 0.1, 0.3),  # share of the letters
    ("variety", 0.3, 0.5, None, None),  # distinct words a word, for texts of 50 to 2 000 words
]
NAMES = [r[0] for r in RULES]


@dataclass
class Model:
    """``good[j]``: how often rule j votes for a good text; ``bad[j]``: how often against a bad one."""

    prior: float
    good: list[float]
    bad: list[float]


START = Model(0.85, [0.98] * len(RULES), [0.4] * len(RULES))
PRIOR_SHARE = 0.1  # weight of START in the estimate, as a share of the texts


def _length(c: Column) -> Column:
    return F.length(c).cast("long")


def _share(part: str | Column, whole: str | Column) -> Column:
    """Null where there is nothing to take a share of."""
    p, w = (F.col(x) if isinstance(x, str) else x for x in (part, whole))
    return F.when(w > 0, p.cast("double") / w)


def _repeated_words(words: str, n: str) -> Column:
    """Words covered by windows that occur at least twice. Windows are told apart by 64 bits first; only
    where two agree are they sorted, by 128 bits, to find which."""
    w = F.col(words)
    # Hashes of 2, 4 and 8 words from those of 1, 2 and 4: each zips an array with itself, moved on.
    keys = F.transform(w, lambda x: F.xxhash64(x))
    for step in (1, 2, 4):
        keys = F.transform(F.array(keys), lambda h: F.zip_with(
            h, F.slice(h, step + 1, F.greatest(F.size(h) - step, F.lit(0))), lambda a, b: F.xxhash64(a, b)))[0]
    windows = F.greatest(F.col(n).cast("int") - (WINDOW - 1), F.lit(0))
    some = F.size(F.array_distinct(F.slice(keys, 1, windows))) < windows

    def window(i: Column, *salt: Column) -> Column:
        return F.xxhash64(*salt, *[F.get(w, i + k) for k in range(WINDOW)])

    # Not below 0, as a sequence would run backwards where there is no window.
    starts = F.sequence(F.lit(0), F.greatest(windows - 1, F.lit(0)))
    named = F.array_sort(F.transform(starts, lambda i: F.struct(
        window(i).alias("a"), window(i, F.lit(7)).alias("b"), i.alias("at"))))

    def same(a: Column, b: Column) -> Column:
        return (a["a"] == b["a"]) & (a["b"] == b["b"])

    def covered(s: Column) -> Column:
        last = F.size(s) - 1
        twice = F.filter(
            s, lambda x, i: (F.when(i > 0, same(s[F.greatest(i - 1, F.lit(0))], x)).otherwise(False))
            | F.when(i < last, same(s[F.least(i + 1, last)], x)).otherwise(False)
        )
        at = F.array_sort(F.transform(twice, lambda x: x["at"]))
        # Each window adds the words up to the next one, eight at most.
        return F.transform(F.array(at), lambda p: F.when(F.size(p) > 0, F.aggregate(
            F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0), lambda total, x: total + x)).otherwise(0))[0]

    return F.when(
        some, F.transform(F.array(named), lambda s: covered(s))[0]
    ).otherwise(0).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and one column per rule.

    A null text has no words. A text is taken whole, in one row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select("doc_id", text.alias("text")).select(
        "*", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    counts = words.select(
        "doc_id", "text", "words", F.size("words").cast("long").alias("n_words"),
        _length(F.array_join("words", "")).alias("word_chars"),
        _length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        (F.size("words") - F.regexp_count(F.concat(F.lit(" "), "text"), F.lit(NO_LETTER))).cast("long").alias("n_letter_words"),
        F.regexp_count("text", F.lit(SENTENCE_LINE)).cast("long").alias("n_sentence_lines"),
        _length(F.regexp_replace("text", r"[^\p{L}]+", "")).alias("n_letters"),
        _length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).alias("n_capitals"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
    ).select("*", _repeated_words("words", "n_words").alias("n_repeat_words"))
    middling = F.col("n_words").between(50, 2000)
    return counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.col("n_words").cast("double").alias("length"), _share("word_chars", "n_words").alias("word_length"),
        _share("n_symbols", "n_words").alias("symbols"), _share("n_dup_lines", "n_lines").alias("duplicate_lines"),
        _share("n_repeat_words", "n_words").alias("repeats"), _share("n_letter_words", "n_words").alias("letters"),
        _share("n_sentence_lines", "n_lines").alias("sentences"), _share("n_capitals", "n_letters").alias("capitals"),
        F.when(middling, _share("n_distinct", "n_words")).alias("variety"),
    )


def vote(name: str, against_below, for_from, for_to, against_above) -> Column:
    """1 for, 0 against, null abstains; a text without words gets no vote."""
    x = F.col(name)
    against, in_favour = F.lit(False), F.lit(True)
    if against_below is not None:
        against = against | (x < against_below)
    if against_above is not None:
        against = against | (x > against_above)
    if for_from is not None:
        in_favour = in_favour & (x >= for_from)
    if for_to is not None:
        in_favour = in_favour & (x <= for_to)
    return F.when(F.col("n_words") > 0, F.when(against, 0).when(in_favour, 1)).cast("int").alias(f"v_{name}")


def _odds(votes: list[Column], prior, good: list, bad: list) -> Column:
    """Log-odds that a text is good; a rule that abstains says nothing. Rates are numbers or columns."""
    odds = F.log(F.lit(prior) / (1 - F.lit(prior)))
    for v, g, b in zip(votes, good, bad):
        odds = odds + F.when(v == 1, F.log(F.lit(g) / (1 - F.lit(b)))).when(v == 0, F.log((1 - F.lit(g)) / F.lit(b))).otherwise(0.0)
    return odds


def posterior(m: Model) -> Column:
    """Probability that the text behind the votes is good; the prior where all rules abstain."""
    return 1 / (1 + F.exp(-_odds([F.col(f"v_{n}") for n in NAMES], m.prior, m.good, m.bad)))


def _round(patterns: Column, state: Column, weight: Column) -> Column:
    """One step of expectation-maximisation. ``state`` is an array: prior, rates of good, rates of bad texts."""
    k = len(RULES)
    good, bad = [state[1 + j] for j in range(k)], [state[1 + k + j] for j in range(k)]

    def split(x: Column) -> Column:
        p = 1 / (1 + F.exp(-_odds([x["votes"][j] for j in range(k)], state[0], good, bad)))
        return F.struct(x["votes"].alias("votes"), (x["n"] * p).alias("g"), (x["n"] * (1 - p)).alias("b"))

    def maximised(parts: Column) -> Column:
        def total(of) -> Column:
            return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + of(x))

        def rate(share: str, j: int, value: int, start: float) -> Column:
            right = total(lambda x: F.when(x["votes"][j] == value, x[share]).otherwise(0.0))
            cast = total(lambda x: F.when(x["votes"][j].isNotNull(), x[share]).otherwise(0.0))
            return (right + weight * start) / (cast + weight)

        prior = (total(lambda x: x["g"]) + weight * START.prior) / (total(lambda x: x["g"] + x["b"]) + weight)
        goods = [rate("g", j, 1, START.good[j]) for j in range(k)]
        bads = [F.greatest(rate("b", j, 0, START.bad[j]), 1 - goods[j]) for j in range(k)]
        return F.array(prior, *goods, *bads)

    return F.transform(F.array(F.transform(patterns, split)), maximised)[0]


def fit(votes: DataFrame, rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over all texts that pass the base; texts that fail it need no model.

    The votes are counted per pattern; the patterns, 3**9 at most, are one array, and the rounds fold over
    it in one expression. The estimate starts at START and is drawn to it by imagined texts, a tenth as
    many as there are (one at least), so a rule that never votes, or an empty table, leaves it there.
    A vote against is held to be no better sign of a good text than of a bad one.
    """
    columns = [f"v_{n}" for n in NAMES]
    row = (
        votes.where(~_base_failed()).groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("n"))
        .agg(F.array_sort(F.collect_list(F.struct(F.array(*columns).alias("votes"), "n"))).alias("patterns"), F.sum("n").alias("texts"))
        .withColumn("weight", F.greatest(F.col("texts") * PRIOR_SHARE, F.lit(1.0)))
    )
    start = F.array(*[F.lit(float(x)) for x in (START.prior, *START.good, *START.bad)])
    rates = F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)), start, lambda state, _: _round(F.col("patterns"), state, F.col("weight"))
    )
    state = row.select(F.when(F.col("texts") > 0, rates).otherwise(start).alias("state")).first()["state"]
    k = len(RULES)
    return Model(state[0], state[1 : 1 + k], state[1 + k :])


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def judged(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Every document with its measures, votes, base_failed, quality and kept.

    ``docs`` has doc_id and text; other columns are not read. base_failed: fewer than 20 words, or over 30
    percent of them in repeated windows. kept: not base_failed, and quality, the posterior
    probability, is at least one half. A null or empty text fails the base. Repeated rows are judged each,
    and each counts in the estimate; doc_id, null or not, takes no part.
    """
    votes = stored(
        measured(docs).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *[vote(*r) for r in RULES]
        ),
        "votes",
    )
    return votes.select("*", _base_failed().alias("base_failed"), posterior(fit(votes, rounds)).alias("quality")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    return judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def accepted(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with ``quality``; those that are not kept are left out.

    Documents go by a number of their own, so null and repeated ids follow the decision for their row.
    """
    rows = stored(docs.withColumn("quality_row", F.monotonically_increasing_id()), "documents")
    verdict = judged(rows.select(F.col("quality_row").alias("doc_id"), "text")).where("kept")
    return rows.join(verdict.select(F.col("doc_id").alias("quality_row"), F.col("quality").alias("quality_")), "quality_row").drop(
        "quality_row", "quality"
    ).withColumnRenamed("quality_", "quality")


def oracle(rounds: int = ROUNDS) -> str:
    def sql_vote(name, against_below, for_from, for_to, against_above):
        against = " OR ".join([f"{name} < {against_below}"] * (against_below is not None) + [f"{name} > {against_above}"] * (against_above is not None))
        favour = " AND ".join([f"{name} >= {for_from}"] * (for_from is not None) + [f"{name} <= {for_to}"] * (for_to is not None))
        return f"CASE WHEN n_words = 0 THEN NULL WHEN {against} THEN 0 WHEN {favour} THEN 1 END AS v_{name}"

    def odds(good, bad, prior):
        terms = [f"ln({prior} / (1 - {prior}))"]
        for j, n in enumerate(NAMES, 1):
            terms.append(f"CASE v_{n} WHEN 1 THEN ln({good}[{j}] / (1 - {bad}[{j}])) WHEN 0 THEN ln((1 - {good}[{j}]) / {bad}[{j}]) ELSE 0 END")
        return f"1 / (1 + exp(-({' + '.join(terms)})))"

    def rate(n, value, share, start):
        mine = f"coalesce(sum(n * {share}) FILTER (WHERE v_{n} = {value}), 0)"
        both = f"coalesce(sum(n * {share}) FILTER (WHERE v_{n} IS NOT NULL), 0)"
        return f"({mine} + any_value(w) * {start}) / ({both} + any_value(w))"

    goods = ", ".join(rate(n, 1, "p", s) for n, s in zip(NAMES, START.good))
    bads = ", ".join(f"greatest({rate(n, 0, '(1 - p)', b)}, 1 - {rate(n, 1, 'p', g)})" for n, g, b in zip(NAMES, START.good, START.bad))
    return rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), u AS (
  SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS i, len(words) AS n_words FROM w
), g AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, eight) AS n FROM (
    SELECT rid, i, n_words, string_agg(word, ' ') OVER (
      PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS eight FROM u)
  WHERE i <= n_words - {WINDOW - 1}
), q AS (
  SELECT rid, sum(least(coalesce(nxt - i, {WINDOW}), {WINDOW}))::BIGINT AS n_repeat_words
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM g WHERE n > 1) GROUP BY rid
), c AS (
  SELECT w.rid, doc_id, len(words) AS n_words, length(list_aggregate(words, 'string_agg', '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
    len(list_filter(lines, lambda x: regexp_matches(x, '[.!?][\x20\x09\x0B-\x0D]*$'))) AS n_sentence_lines,
    length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS n_letters,
    length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_capitals, len(list_distinct(words)) AS n_distinct
  FROM w LEFT JOIN q USING (rid)
), s AS (
  SELECT *, n_words::DOUBLE AS length, word_chars::DOUBLE / nullif(n_words, 0) AS word_length,
    n_symbols::DOUBLE / nullif(n_words, 0) AS symbols, n_dup_lines::DOUBLE / nullif(n_lines, 0) AS duplicate_lines,
    n_repeat_words::DOUBLE / nullif(n_words, 0) AS repeats, n_letter_words::DOUBLE / nullif(n_words, 0) AS letters,
    n_sentence_lines::DOUBLE / nullif(n_lines, 0) AS sentences, n_capitals::DOUBLE / nullif(n_letters, 0) AS capitals,
    CASE WHEN n_words BETWEEN 50 AND 2000 THEN n_distinct::DOUBLE / n_words END AS variety
  FROM c
), v AS MATERIALIZED (
  SELECT doc_id, n_words::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, {', '.join(sql_vote(*r) for r in RULES)} FROM s
), k AS MATERIALIZED (
  SELECT *, greatest(0.1 * sum(n) OVER (), 1) AS w FROM (
    SELECT {', '.join('v_' + n for n in NAMES)}, count(*) AS n FROM v
    WHERE NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words) GROUP BY ALL)
), em(it, prior, good, bad) AS (
  SELECT 0, {START.prior}::DOUBLE, {START.good}::DOUBLE[], {START.bad}::DOUBLE[]
  UNION ALL
  SELECT it + 1, (sum(n * p) + any_value(w) * {START.prior}) / (sum(n) + any_value(w)), [{goods}], [{bads}]
  FROM (SELECT em.it, k.*, {odds('em.good', 'em.bad', 'em.prior')} AS p FROM em, k WHERE em.it < {rounds}) GROUP BY it
), f AS (SELECT * FROM em WHERE it = {rounds})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words)
    AND {odds('f.good', 'f.bad', 'f.prior')} >= 0.5 AS kept
FROM v, f"""
