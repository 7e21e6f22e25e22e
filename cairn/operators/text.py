"""Text enrichment as Spark jobs.

The hosted language models of the source are not reproducible; what is kept
is the shape of each function (score range, closed label set, first answer
of an array, one-line gist) and the pipeline around it. Scoring uses
lexicons passed as parameters, and ``enrich_with`` is the plug for a real
model.

Plan choice: a lexicon is a small literal (a fixed-size parameter, not
data), so hits are counted per row with higher-order array functions
(``filter`` + ``array_contains`` over the token array). That is a narrow
projection: no explode, no join, no shuffle, and a document
of any length is processed whole inside its own row. Only the summariser
needs corpus statistics (document frequency), which is a real aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.sources import files
from cairn.sources.answers import AnswerCache, answered, digest

TOKEN_SPLIT = r"[^\p{L}]+"
SENTENCE_SPLIT = r"[.!?\n]+"
FREQUENT = 2000  # fixed value: the most tokens that are dealt out in parts

# fixed values: default lexicons (multilingual support vocabulary)
POSITIVE = ["good", "great", "thanks", "thank", "love", "excellent", "happy", "best", "perfect",
            "bien", "merci", "gut", "danke", "bueno", "gracias", "genial"]
NEGATIVE = ["bad", "broken", "damaged", "late", "never", "not", "no", "terrible", "angry", "worst",
            "refund", "nicht", "kein", "pas", "jamais", "nunca", "mal", "problema"]
CATEGORIES = {
    "shipping damage": ["damaged", "broken", "crushed", "box", "package", "cassé", "beschädigt", "dañado"],
    "billing issue": ["bill", "billing", "invoice", "charge", "charged", "payment", "payments", "facture",
                      "rechnung", "factura"],
    "delivery delay": ["late", "delay", "delayed", "waiting", "tracking", "retard", "verspätet", "retraso"],
    "product question": ["question", "how", "what", "size", "color", "comment", "wie", "was", "cómo", "qué"],
}
ROUTES = {
    "REFUNDS": ["refund", "return", "money", "remboursement", "erstattung", "reembolso"],
    "BILLING": ["bill", "invoice", "charge", "charged", "payment", "payments", "facture", "rechnung", "factura"],
    "SHIPPING": ["shipping", "delivery", "package", "tracking", "livraison", "lieferung", "envío"],
    "PRODUCT_HELP": ["help", "how", "question", "use", "aide", "hilfe", "ayuda"],
}
# literal every match must contain: texts without it skip the regex scan
ANSWER_GUARDS = {"email": "@", "phone": "-", "date": "-"}
ANSWER_PATTERNS = {  # question type -> (pattern, capture group holding the answer)
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]+", 0),
    "phone": (r"[0-9]{3}-[0-9]{4}", 0),
    "order": (r"(?i)order\s*(?:number\s*)?#?\s*([0-9]+)", 1),
    "date": (r"[0-9]{4}-[0-9]{2}-[0-9]{2}", 0),
}


def tokens(text: Column) -> Column:
    """Lower-case letter runs of the whole text."""
    return F.array_remove(F.split(F.lower(text), TOKEN_SPLIT), "")


def with_tokens(df: DataFrame, text_col: str, out: str = "_tok") -> DataFrame:
    """Materialise the token array once; later stages reference the column.
    (Higher-order functions get fresh lambda ids per call, so two separate
    calls on the text would tokenise it twice.)"""
    return df.withColumn(out, tokens(F.col(text_col)))


def _word_counts(toks: Column, words: Sequence[str]) -> Column:
    """``[{w, n}]`` for the lexicon words present in the tokens, with their
    number of occurrences. ``array_intersect`` (hash based, code-generated)
    finds the few words present in one pass; each present word is then
    counted with one ``array_remove`` pass, so the work per document is
    bounded by the lexicon size, whatever the text length."""
    lex = F.array(*[F.lit(w) for w in dict.fromkeys(words)])
    present = F.array_intersect(toks, lex)
    return F.transform(present, lambda w: F.struct(
        w.alias("w"), (F.size(toks) - F.size(F.array_remove(toks, w))).alias("n")))


def _sum_hits(hits: Column, terms: Sequence[str]) -> Column:
    """Occurrences of ``terms`` among the counted hits."""
    arr = F.array(*[F.lit(t) for t in terms])
    return F.aggregate(hits, F.lit(0), lambda acc, x: acc + F.when(F.array_contains(arr, x["w"]), x["n"])
                       .otherwise(F.lit(0)))


def with_sentiment(df: DataFrame, tok_col: str, out: str = "sentiment_score",
                   positive: Sequence[str] = POSITIVE, negative: Sequence[str] = NEGATIVE) -> DataFrame:
    """(pos - neg) / (pos + neg) in [-1, 1]; 0 when nothing matches.
    A word in both lists counts on both sides."""
    df = df.withColumn("_hits", _word_counts(F.col(tok_col), list(positive) + list(negative)))
    df = df.withColumn("_pos", _sum_hits(F.col("_hits"), positive)) \
           .withColumn("_neg", _sum_hits(F.col("_hits"), negative))
    score = F.when(F.col("_pos") + F.col("_neg") == 0, F.lit(0.0)).otherwise(
        (F.col("_pos") - F.col("_neg")).cast("double") / (F.col("_pos") + F.col("_neg")).cast("double"))
    return df.withColumn(out, score).drop("_hits", "_pos", "_neg")


def with_label(df: DataFrame, tok_col: str, labels: Mapping[str, Sequence[str]], out: str,
               default: str | None = None) -> DataFrame:
    """The label with most term hits; ties go to the earlier label,
    no hit at all to ``default`` (the last label unless given). The answer
    is always one of the labels."""
    names = list(labels)
    default = names[-1] if default is None else default
    n = len(names)
    df = df.withColumn("_hits", _word_counts(F.col(tok_col), [t for name in names for t in labels[name]]))
    cand = F.array(*[F.struct(_sum_hits(F.col("_hits"), labels[name]).alias("hits"),
                              F.lit(n - i).alias("order"), F.lit(name).alias("label"))
                     for i, name in enumerate(names)])
    df = df.withColumn("_best", F.array_max(cand))
    return (df.withColumn(out, F.when(F.col("_best.hits") > 0, F.col("_best.label")).otherwise(F.lit(default)))
              .drop("_hits", "_best"))


def extract_answers(text: Column, kind: str) -> Column:
    """T4: every span answering a question type, as an array of
    ``{answer, score}`` in text order; score 1, 1/2, 1/3 ... by position."""
    pattern, group = ANSWER_PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), group)
    guard = ANSWER_GUARDS.get(kind)
    if guard is not None:
        found = F.when(F.instr(text, guard) > 0, found).otherwise(F.array().cast("array<string>"))
    return F.transform(found, lambda x, i: F.struct(x.alias("answer"),
                                                    (F.lit(1.0) / (i + 1)).alias("score")))


def first_answer(text: Column, kind: str) -> Column:
    """T4: ``EXTRACT_ANSWER(...)[0]:answer``."""
    return F.try_element_at(extract_answers(text, kind), F.lit(1))["answer"]


def token_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """A row for each distinct token of each row's text, found inside the row;
    the other columns stay. Counted per ``tok`` this is document frequency, and
    of a change feed its signed change."""
    others = [c for c in docs.columns if c != text_col]
    found = F.array_distinct(F.split(F.lower(F.col(text_col)), TOKEN_SPLIT))
    return docs.select(*others, F.explode(found).alias("tok")).filter(F.col("tok") != "")


def frequent(frequencies: DataFrame, most: int = FREQUENT) -> DataFrame:
    """The tokens with at least 1 / ``most`` of all the counts (never more than
    ``most`` rows, whatever the size of the table), and how many such shares
    each has: (tok, shares)."""
    total = frequencies.agg(F.sum("df")).first()[0] or 0
    often = frequencies.filter((F.col("df") > 0) & (F.col("df") * most >= total))
    return often.select("tok", F.ceil(F.col("df") * most / F.lit(float(total))).cast("int").alias("shares"))


def summarize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              frequencies: DataFrame | None = None, most_frequent: int = FREQUENT) -> DataFrame:
    """Extractive one-line gist per document: the sentence whose tokens
    have the highest mean document frequency (ties: earliest sentence).

    * Document frequencies (tok, df) are counted over ``docs``, one shuffle
      with a row per token and task, or given: ``streaming.frequencies`` keeps
      them under changes, so that new documents are summarised without
      reading the others. A token that they lack counts 0. They are staged as
      the frame is built: several steps read them.
    * Sentence scores: tokens are joined to the frequencies (the table grows
      with the vocabulary, so no join is forced) and aggregated per sentence.
      A token of most sentences would bring a share of all rows to one task,
      so the ``most_frequent`` ones, a short list at any size, are dealt out
      in parts by sentence, and their counts are copied to each part.
    * The best sentence per document is a ``max`` over (score, -position),
      an aggregate rather than a window; its text is cut out of the document
      again by its position."""
    pieces = F.split(F.col(text_col), SENTENCE_SPLIT)
    toks = (docs.select(id_col, F.posexplode(pieces).alias("pos", "s"))
                .select(id_col, "pos", F.explode(F.split(F.lower("s"), TOKEN_SPLIT)).alias("tok")).filter(F.col("tok") != ""))
    if frequencies is None:
        dfreq, how = token_rows(docs.select(text_col), text_col).groupBy("tok").agg(F.count(F.lit(1)).alias("df")), "inner"
    else:
        dfreq, how = frequencies.select("tok", "df"), "left"
    dfreq = files.staged(dfreq, "frequencies")
    top = F.broadcast(frequent(dfreq, most_frequent))
    part = F.when(F.col("shares").isNull(), 0).otherwise(F.pmod(F.xxhash64(id_col, "pos"), F.col("shares")).cast("int"))
    toks = toks.join(top, "tok", "left").select(id_col, "pos", "tok", part.alias("_part"))
    dfreq = dfreq.join(top, "tok", "left").select("tok", "df", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)).alias("_part"))
    scored = (toks.join(dfreq, ["tok", "_part"], how).groupBy(id_col, "pos")
              .agg((F.coalesce(F.sum("df"), F.lit(0)).cast("double") / F.count(F.lit(1))).alias("score")))
    best = scored.groupBy(id_col).agg(F.max(F.struct("score", (-F.col("pos")).alias("neg_pos"))).alias("_best"))
    return (docs.join(best, id_col)
                .select(id_col, F.trim(F.element_at(pieces, 1 - F.col("_best.neg_pos"))).alias("summary"),
                        F.round("_best.score", 6).alias("score")))


def enrich_with(df: DataFrame, text_col: str, fn: Callable[[pd.Series], pd.Series],
                out_col: str, dedupe: bool = True, sent: Column | None = None,
                cache: AnswerCache | None = None) -> DataFrame:
    """Apply an external text function (a model, a remote service) in parts of
    Arrow batches to the rows where ``sent`` is TRUE (all, unless given); the others
    and NULL texts get NULL. With ``dedupe`` each distinct text is sent once,
    and the answer is joined back by a 128-bit digest of the text; copies (a
    third of all rows may be one text) collapse before they are shuffled.
    A ``cache`` keeps answers across runs: only texts new to it are sent, as
    the frame is built. Rows that are not sent have digests too, so they spread
    over the join's partitions like the others."""
    keyed = df.withColumns({"_digest": digest(F.col(text_col)), "_sent": F.col(text_col).isNotNull() & F.coalesce(F.lit(True) if sent is None else sent, F.lit(False))})
    if not dedupe:
        answer = F.pandas_udf(fn, T.StringType())(F.when(F.col("_sent"), F.col(text_col)))
        return keyed.withColumn(out_col, answer).drop("_digest", "_sent")
    texts = keyed.filter("_sent").select(F.col("_digest").alias("digest"), F.col(text_col).alias("text")).dropDuplicates(["digest"])
    answers = cache.learn(texts, fn) if cache else answered(texts, fn)
    answers = answers.select(F.col("digest").alias("_of"), F.col("answer").alias("_answer"))
    joined = keyed.join(answers, F.col("_digest") == F.col("_of"), "left")
    return joined.withColumn(out_col, F.when(F.col("_sent"), F.col("_answer"))).drop("_digest", "_sent", "_of", "_answer")


def translate_route(df: DataFrame, text_col: str, lang_col: str,
                    fn: Callable[[pd.Series], pd.Series], target: str = "en",
                    out_col: str = "english_text", cache: AnswerCache | None = None) -> DataFrame:
    """T5: only rows whose language differs from ``target`` go through the
    translator; the rest pass through unchanged, as do rows without a
    language. A ``cache`` keeps translations across runs."""
    foreign = F.coalesce(F.col(lang_col) != target, F.lit(False))
    done = enrich_with(df, text_col, fn, "_translated", sent=foreign, cache=cache)
    return done.withColumn(out_col, F.when(foreign, F.col("_translated")).otherwise(F.col(text_col))).drop("_translated")


def stand_in_translator(s: pd.Series) -> pd.Series:
    """A deterministic stand-in for a translation model."""
    return "[en] " + s
