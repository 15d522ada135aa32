"""Quality rules as a ledger of failure bits.

Each rule is evaluated once per document. The ledger keeps the measurements and
one bit per failed rule; a policy is a named mask over these bits, so a new
policy, or the effect of leaving a rule out, needs no second look at the texts.

Defined results: a null text has no words, no lines and no symbols, and fails
`few_words`, as an empty text does. Repeated rows are judged one by one. A very
long text takes memory for a few numbers per word, not for copies of its words. An
empty table gives no rows. Columns other than id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import held, with_row

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: A rule's bit is its place in this list: never reorder, only append.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "many_symbols": "10 * n_symbols > n_words",
    "long_words": "word_chars > 20 * n_words",
    "short_words": "word_chars < 2 * n_words",
}
#: Versioned policies: the rules whose failure rejects a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(RULES),
}
CURRENT = "v1"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def mask(policy: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in POLICIES[policy])


def _windows(of: str) -> str:
    return f"transform(sequence(0, n_words - {WINDOW}), i -> {of})"


def measure(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id and MEASURES, with `carry` also the whole row as `doc`.

    Each text is split once and stays in its row.
    """
    rest = ["doc"][: int(carry)]
    rows = with_row(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *rest)
    rows = held(
        rows,
        words=F.regexp_extract_all("text", F.lit(WORD), F.lit(0)),
        lines=F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)),
    )
    rows = held(rows, n_words=F.size("words"), hashes=F.expr("transform(words, w -> xxhash64(w))"))
    at = ", ".join(f"hashes[i + {k}]" for k in range(WINDOW))
    rows = held(
        rows,
        window_hashes=F.expr(f"if(n_words < {WINDOW}, array(), {_windows(f'xxhash64({at})')})"),
    )
    # Equal windows have equal hashes, so a text without equal hashes repeats nothing.
    # In the others, windows of equal hashes are compared word by word, where they stand.
    rows = held(
        rows,
        places=F.expr(
            """if(size(array_distinct(window_hashes)) = size(window_hashes), NULL,
            sort_array(transform(window_hashes, (h, i) -> struct(h, i))))"""
        ),
    )
    same = " AND ".join(f"words[x.i + {k}] = words[get(places, k + {{}}).i + {k}]" for k in range(WINDOW))
    meets = [f"coalesce(get(places, k + {d}).h = x.h AND {same.format(*[d] * WINDOW)}, false)" for d in (-1, 1)]
    rows = held(
        rows,
        starts=F.expr(f"sort_array(transform(filter(places, (x, k) -> {' OR '.join(meets)}), x -> x.i))"),
    )
    covered = f"""coalesce(aggregate(starts, struct(0 AS n, 0 AS upto), (a, p) ->
        struct(a.n + least({WINDOW}, p + {WINDOW} - a.upto) AS n, p + {WINDOW} AS upto), a -> a.n), 0)"""
    length = F.char_length
    return rows.select(
        "doc_id",
        *rest,
        F.col("n_words").cast("long").alias("n_words"),
        length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (length("text") - length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(covered).cast("long").alias("n_repeat_words"),
    )


def ledger(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, MEASURES and fail_bits: a row per document; with `carry` also `doc`."""
    bits = [F.expr(f"if({rule}, {1 << k}L, 0L)") for k, rule in enumerate(RULES.values())]
    total: Column = sum(bits[1:], bits[0])
    return held(measure(docs, carry), fail_bits=total)


def passes(policy: str) -> Column:
    """Whether a row of the ledger passes the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0


def ablations(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of the policy: documents failing it, and those failing nothing else.

    The second number is what would be kept in addition without the rule. The
    ledger is first counted by its bits, so only a few rows are shuffled.
    """
    names = list(RULES)
    counts = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask(policy))).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rules = F.array(
        *[
            F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit"))
            for r in POLICIES[policy]
        ]
    )
    return (
        counts.select("bits", "n", F.inline(rules))
        .groupBy("rule")
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_fail"),
            F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        )
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """The ledger with the verdicts of the base policy and of the current one."""
    return ledger(docs).select(
        "doc_id",
        *MEASURES,
        "fail_bits",
        (~passes("base")).alias("base_failed"),
        passes(CURRENT).alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass the current policy, with all their columns."""
    return ledger(docs, carry=True).filter(passes(CURRENT)).select("doc.*")


ORACLE_SQL = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, words[i : i + 4] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM split)
), twice AS (
  SELECT doc_id, unnest(places) AS i
  FROM (SELECT doc_id, list(i) AS places FROM windows GROUP BY doc_id, w HAVING count(*) > 1)
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM twice, (SELECT unnest(range(5)) AS k) GROUP BY doc_id
), measured AS (
  SELECT s.doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN covered c USING (doc_id)
), failed AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 4 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 20 * n_words THEN 16 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END)::BIGINT AS fail_bits
  FROM measured
)
SELECT *, fail_bits & 3 <> 0 AS base_failed, fail_bits & 63 = 0 AS kept FROM failed
"""
