"""URL filter: prefix rules first, then a weighted vocabulary.

One Aho-Corasick automaton per task finds every vocabulary term of a URL in
one pass. A term counts where both neighbours are no ASCII letter or digit.
A strict term weighs as much as the rejection threshold, a soft one less, and
every term counts once, so one strict or several distinct soft terms reject.

Defined cases: a NULL URL, or one without ``://``, has an empty host and path,
fits no rule, and its text is still searched (NULL: no hits, allowed). An
empty vocabulary finds nothing, and without rules none fits. An
empty path fits no rule, because the rules' paths begin with a slash. Repeated
rows give repeated results. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import ascii_lower, ddl

STRICT = ("casino porn porno xxx hentai escort escorts viagra cialis warez "
          "camgirls nudes phishing malware spam").split()
SOFT = ("adult ads bet bets betting bonus cheap crack dating farm free jackpot "
        "loan loans pill pills poker slots torrent track tracker win").split()
REJECT_AT = 2.0
VOCABULARY = {**dict.fromkeys(STRICT, REJECT_AT), **dict.fromkeys(SOFT, 1.0)}
#: (rule, verdict); a rule is a host with a path prefix.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return ascii_lower(raw), path


def fits(rule: str, host: Column, path: Column) -> Column:
    cut = rule.index("/")
    name, prefix = rule[:cut], rule[cut:]
    return ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)


def first_fit(rules, host: Column, path: Column, value) -> Column:
    """``value(rule, verdict)`` of the longest fitting rule, else NULL."""
    ranked = sorted(rules, key=lambda r: -len(r[0]))
    return F.coalesce(F.lit(None).cast("string"), *(F.when(fits(r, host, path), F.lit(value(r, v))) for r, v in ranked))


def with_hits(df: DataFrame, url: str, vocabulary: dict[str, float], reject_at: float) -> DataFrame:
    """Append n_strict, n_soft (distinct terms found) and score."""
    kinds = {t: w >= reject_at for t, w in vocabulary.items()}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for term in vocabulary:
            machine.add_word(term, term)
        if vocabulary:
            machine.make_automaton()

        def hits(text: str | None) -> set[str]:
            if not vocabulary:  # an automaton needs a word
                return set()
            low = "".join(c.lower() if c.isascii() else c for c in text or "")
            edge = lambda i: not (0 <= i < len(low) and low[i].isascii() and low[i].isalnum())
            return {t for end, t in machine.iter(low) if edge(end + 1) and edge(end - len(t))}

        for batch in batches:
            found = [hits(u) for u in batch.column(url).to_pylist()]
            extra = {
                "n_strict": pa.array([sum(kinds[t] for t in f) for f in found], pa.int64()),
                "n_soft": pa.array([sum(not kinds[t] for t in f) for f in found], pa.int64()),
                "score": pa.array([float(sum(vocabulary[t] for t in f)) for f in found], pa.float64()),
            }
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra.values()], names=[*batch.schema.names, *extra])

    return df.mapInArrow(search, f"{ddl(df)}, n_strict long, n_soft long, score double")


def judge_urls(df: DataFrame, key: str = "page_id", url: str = "url", rules=RULES,
               vocabulary: dict[str, float] = VOCABULARY, reject_at: float = REJECT_AT) -> DataFrame:
    """One row per input row: key, host, path, rule, verdict, n_strict, n_soft, score."""
    host, path = host_and_path(F.col("url"))
    scored = with_hits(df.select(F.col(key).alias("key"), F.col(url).alias("url")), "url", vocabulary, reject_at)
    placed = scored.select(F.col("key").alias(key), F.coalesce(host, F.lit("")).alias("host"),
                           F.coalesce(path, F.lit("")).alias("path"), "n_strict", "n_soft", "score")
    h, p = F.col("host"), F.col("path")
    by_words = F.when(F.col("score") >= reject_at, "block").otherwise("allow")
    return placed.select(key, "host", "path", first_fit(rules, h, p, lambda r, v: r).alias("rule"),
                         F.coalesce(first_fit(rules, h, p, lambda r, v: v), by_words).alias("verdict"),
                         "n_strict", "n_soft", "score")


def oracle(vocabulary: dict[str, float] = VOCABULARY, reject_at: float = REJECT_AT) -> str:
    """The same judgement in DuckDB SQL, with a regular expression per term."""
    low = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    hit = lambda t: f"CAST(regexp_matches({low}, '(^|[^a-z0-9]){t}($|[^a-z0-9])') AS BIGINT)"
    strict = " + ".join(hit(t) for t, w in vocabulary.items() if w >= reject_at)
    soft = " + ".join(hit(t) for t, w in vocabulary.items() if w < reject_at)
    return f"""
WITH split AS (
  SELECT page_id, {strict} AS n_strict, {soft} AS n_soft,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, n_strict, n_soft,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM split),
ruled AS (
  SELECT *, {reject_at} * n_strict + n_soft AS score,
    CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN score >= {reject_at} THEN 'block' ELSE 'allow' END AS verdict,
  n_strict, n_soft, CAST(score AS DOUBLE) AS score
FROM ruled"""
