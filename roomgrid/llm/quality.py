"""Quality rules: counts of one text, and lines that recur over the documents of a host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomgrid.llm.common import SPACES, let, stored, table, words

SYMBOLS = "#*$%&|<>"
MAX_SHARE = 0.05  # of a host's different texts; a line in more of them is furniture
MIN_DOCUMENTS = 50  # and it has to be in more than so many
MIN_LEFT = 50  # percent of a document's words that have to stay


def _lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(SPACES)) != "")


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def repeated_words(ws: Column) -> Column:
    """How many of the words lie in a window of three that is there twice or more."""

    def windows(w: Column) -> Column:
        return F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            placed,
            lambda s: F.filter(
                F.transform(s, lambda x, k: F.when((x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"])),
                lambda i: i.isNotNull(),
            ),
        )
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda i: F.array(i, i + 1, i + 2)))))

    return let(ws, lambda w: let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))))


def normal_line(line: Column) -> Column:
    """Lower case, one blank for white space, one zero for a run of digits."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.trim(line, F.lit(SPACES)), r"[\x20\x09-\x0D]+", " "), "[0-9]+", "0"))


def quality(
    df: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_share: float = MAX_SHARE,
    min_documents: int = MIN_DOCUMENTS,
    min_left: int = MIN_LEFT,
) -> DataFrame:
    """Per row of ``df``: the counts of its text, ``base_failed``, ``n_removed`` and ``kept``.

    A line is removed from the documents of a host if more than ``min_documents`` of the
    host's different texts hold it in its normal form, and more than ``max_share`` of them.
    Copies of a text count once, so copies do not make their own lines common. A document is
    kept unless the base counts fail it or less than ``min_left`` percent of its words are
    outside removed lines (``n_removed`` words are inside).

    A null text has no words; null hosts form one host; a null id is an id. Rows with the
    same id, text and host get the same answer each. Other columns are ignored. An empty
    table gives no rows.

    Lines are counted by hash in two steps, by (line, text) and then by line, each summed
    before it is shuffled; the removed lines of a host are joined, not broadcast by force.
    """
    docs = df.select(
        F.col(doc).alias("doc"),
        F.col(text).alias("text"),
        F.xxhash64(F.col(host).isNull(), F.col(host)).alias("host"),
        F.xxhash64(F.col(text).isNull(), F.col(text)).alias("key"),
    )
    numbered = F.transform(
        _lines(F.col("text")),
        lambda line: F.struct(F.xxhash64("host", normal_line(line)).alias("line"), F.size(words(line)).alias("n")),
    )
    lines = stored(
        docs.select("doc", "host", "key", F.explode(numbered).alias("l"))
        .groupBy("doc", "host", "key", F.col("l.line").alias("line"))
        .agg(F.sum("l.n").alias("n"), F.count("*").alias("places")),
        "lines",
    )
    texts = docs.where("text is not null").groupBy("host", "key").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("texts"))
    common = (
        lines.groupBy("host", "line", "key").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > min_documents)
        .join(texts, "host")
        .where(F.col("n") > max_share * F.col("texts"))
        .select("line")
    )
    rows = docs.groupBy("doc", "host", "key").agg(F.count("*").alias("rows"))
    removed = (
        lines.join(common, "line")
        .groupBy("doc", "host", "key")
        .agg(F.sum("n").alias("n"))
        .join(rows.withColumnsRenamed({"doc": "d", "host": "h", "key": "k"}), F.col("doc").eqNullSafe(F.col("d")) & (F.col("host") == F.col("h")) & (F.col("key") == F.col("k")))
        .select("d", "h", "k", F.expr("n div rows").alias("n_removed"))  # repeated rows added their lines up
    )
    symbols = F.length("text") - _without(F.col("text"), SYMBOLS)
    counted = docs.select(
        "doc", "host", "key",
        F.coalesce(_without(F.col("text"), SPACES), F.lit(0)).cast("long").alias("word_chars"),
        F.coalesce(symbols, F.lit(0)).cast("long").alias("n_symbols"),
        F.coalesce(let(_lines(F.col("text")), lambda x: F.size(x) - F.size(F.array_distinct(x))), F.lit(0)).cast("long").alias("n_dup_lines"),
        let(words(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).cast("long").alias("r"))).alias("w"),
    )
    joined = counted.join(removed, F.col("doc").eqNullSafe(F.col("d")) & (F.col("host") == F.col("h")) & (F.col("key") == F.col("k")), "left")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = 100 * (F.col("n_words") - F.col("n_removed")) >= min_left * F.col("n_words")
    return (
        joined.select(
            F.col("doc").alias(doc), F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
            F.col("w.r").alias("n_repeat_words"), F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        )
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & left)
    )


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents"))


OP8_SQL = r"""
with docs as (
  select doc_id, coalesce(text, '') as text, coalesce(source, '(null)') as host from documents
), split as (
  select *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from docs
), lines as (
  select doc_id, host, text, len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) as n,
    lower(regexp_replace(array_to_string(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> ''), ' '), '[0-9]+', '0', 'g')) as line
  from (select doc_id, host, text, unnest(l) as line from split)
), common as (
  select host, line from lines join (select host, count(distinct text) as texts from docs group by host) using (host)
  group by host, line, texts having count(distinct text) > 50 and count(distinct text) > 0.05 * texts
), removed as (
  select doc_id, cast(sum(n) as bigint) as n_removed from lines semi join common using (host, line) group by doc_id
), placed as (
  select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from split
), threes as (
  select doc_id, i, word || ' ' || lead(word, 1) over d || ' ' || lead(word, 2) over d as three from placed
  window d as (partition by doc_id order by i)
), twice as (
  select doc_id, i from threes where three is not null qualify count(*) over (partition by doc_id, three) > 1
), repeated as (
  select doc_id, count(distinct i + k) as n from twice, range(3) r(k) group by doc_id
), counted as (
  select doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
    coalesce(r.n, 0) as n_repeat_words, coalesce(n_removed, 0) as n_removed
  from split left join repeated r using (doc_id) left join removed using (doc_id)
)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 100 * (n_words - n_removed) >= 50 * n_words as kept
from counted
"""
