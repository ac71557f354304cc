"""Line dedup: runs of lines that stood earlier in the corpus are deleted.

A *stretch* is a shortest row of consecutive lines with at least ``min_words`` words: the one
that begins at a line, or the one that ends there. Lines without a word are passed over; two
lines are equal if their words are. A line goes if it lies in a stretch whose lines stood in
the same order at an earlier place: an earlier document (by id, null first, then by a hash of
the text), or earlier in the same one without touching. So a repeated run of ``min_words``
words or more goes as a whole, however it is placed, and a shorter one stays.

1. *Winnowing.* The least line hash of a stretch is its fingerprint. Two places that share a
   run share the stretches in it, hence a fingerprint at the same line of the run. Which
   line is picked depends on the stretch alone.
2. *Positions are joined.* Fingerprints picked at a single place cannot be in a repeated run;
   only the stretches around the others go on.
3. *Matches are extended both ways.* Around a shared fingerprint the stretches that begin
   before it reach over the lines after it, those that end after it reach back. The stretches
   are compared whole, by a hash of all their line hashes, with the first place only. No pair
   of later places is formed, so a passage in a third of all documents costs one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomgrid.llm.common import let, stored, table, words

MIN_WORDS = 50


def _content_lines(text: Column) -> Column:
    """(place, hash, words) of the lines with a word."""
    numbered = F.transform(
        F.split(text, "\n"),
        lambda line, i: let(words(line), lambda w: F.struct(i.alias("i"), F.xxhash64(w).alias("h"), F.size(w).alias("n"))),
    )
    return F.filter(numbered, lambda line: line["n"] > 0)


def _stretch(lines: Column, min_words: int, seed: int) -> Column:
    """Fold lines until they have enough words: last line's place, hash of all, least hash and its place."""
    start = F.struct(
        F.lit(0).alias("n"), F.lit(-1).alias("end"), F.lit(seed).cast("long").alias("all"),
        F.lit((1 << 63) - 1).alias("least"), F.lit(-1).alias("at"),
    )

    def step(acc: Column, line: Column) -> Column:
        less = line["h"] < acc["least"]
        longer = F.struct(
            (acc["n"] + line["n"]).alias("n"), line["i"].alias("end"), F.xxhash64(acc["all"], line["h"]).alias("all"),
            F.when(less, line["h"]).otherwise(acc["least"]).alias("least"), F.when(less, line["i"]).otherwise(acc["at"]).alias("at"),
        )
        return F.when(acc["n"] >= min_words, acc).otherwise(longer)

    return F.aggregate(lines, start, step)


def _stretches(lines: Column, min_words: int) -> Column:
    """All stretches of a text: (first, last, all, least, at)."""
    near = 4  # most stretches are this short; none has more than min_words lines

    def fold(take, seed: int) -> Column:
        short = _stretch(take(min(near, min_words)), min_words, seed)
        return let(short, lambda s: F.when(s["n"] >= min_words, s).otherwise(_stretch(take(min_words), min_words, seed)))

    def shape(s: Column, first: Column, last: Column) -> Column:
        return F.when(
            s["n"] >= min_words,
            F.struct(first.alias("first"), last.alias("last"), s["all"].alias("all"), s["least"].alias("least"), s["at"].alias("at")),
        )

    def forward(x: Column, k: Column) -> Column:
        return let(fold(lambda n: F.slice(lines, k + 1, n), 1), lambda s: shape(s, x["i"], s["end"]))

    def backward(x: Column, k: Column) -> Column:
        def take(n: int) -> Column:
            begin = F.greatest(k + 2 - n, F.lit(1))
            return F.reverse(F.slice(lines, begin, k + 2 - begin))

        return let(fold(take, 2), lambda s: shape(s, s["end"], x["i"]))

    return F.filter(F.concat(F.transform(lines, forward), F.transform(lines, backward)), lambda s: s.isNotNull())


def repeated_runs(df: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, key, runs): places (first, last) of the stretches to delete, by id and hash of the text."""
    source = df.select(F.col(doc).alias("doc"), F.xxhash64(F.col(text)).alias("key"), F.col(text).alias("text")).where("text is not null")
    found = stored(
        source.select("doc", "key", F.explode(let(_content_lines(F.col("text")), lambda x: _stretches(x, min_words))).alias("s")).select("doc", "key", "s.*"),
        "stretches",
    )
    place = F.xxhash64("doc", "key", "at")
    shared = found.groupBy("least").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("least")
    around = found.join(shared, "least").select("all", F.struct("doc", "key", "first", "last").alias("p"))
    first = around.groupBy("all").agg(F.min("p").alias("f"), F.max("p").alias("l")).where("f < l").select("all", "f")
    later = around.join(first, "all").where(
        "p > f and not (p.doc <=> f.doc and p.key = f.key and p.first <= f.last)"
    )
    return later.groupBy("p.doc", "p.key").agg(F.collect_set(F.struct("p.first", "p.last")).alias("runs"))


def dedup_lines(df: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of ``df``, ``text`` without repeated runs, and ``_lines``, ``_deleted``.

    ``_lines`` counts the lines that hold a word, ``_deleted`` those of them that went. A
    text that loses its last word becomes empty; lines without words inside a deleted run go
    with it, others stay. A null text stays null with no lines. Rows with the same id and
    text count as one place and are treated alike. An empty table gives no rows.
    """
    runs = repeated_runs(df, doc, text, min_words)
    rows = df.select(F.struct("*").alias("row"))
    text_of = F.col("row")[text]
    joined = rows.join(runs, F.col("row")[doc].eqNullSafe(F.col("doc")) & (F.xxhash64(text_of) == F.col("key")), "left")
    gone = F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["first"], r["last"]))))
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")

    def cut(lines: Column) -> Column:
        left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i))
        return let(
            left,
            lambda kept: F.struct(
                F.when(F.exists(kept, has_word), F.array_join(kept, "\n")).otherwise("").alias("text"),
                F.size(F.filter(kept, has_word)).cast("long").alias("left"),
            ),
        )

    lines = F.size(F.filter(F.split(F.coalesce(text_of, F.lit("")), "\n"), has_word)).cast("long")
    cutting = joined.select("row", lines.alias("lines"), F.when(F.col("runs").isNotNull(), let(F.split(text_of, "\n"), cut)).alias("cut"))
    rest = [F.col("row")[c].alias(c) if c != text else F.when(F.col("cut").isNull(), text_of).otherwise(F.col("cut.text")).alias(text) for c in df.columns]
    deleted = F.when(F.col("cut").isNull(), F.lit(0).cast("long")).otherwise(F.col("lines") - F.col("cut.left"))
    return cutting.select(*rest, F.col("lines").alias("_lines"), deleted.alias("_deleted"))


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents: their texts without repeated runs, and how many lines went."""
    found = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", F.col("_lines").alias("n_lines"), F.col("_deleted").alias("n_deleted"))


#: The lines that go, as (doc_id, text, first, last) in ``gone``; {documents} names the table.
REPEATED_SQL = r"""
places as (
  select distinct doc_id, text, i, line, list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from (select doc_id, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from {documents})
), content as (
  select doc_id, text, i, array_to_string(w, ' ') as line, len(w) as n,
    row_number() over d as k, sum(len(w)) over (d rows unbounded preceding) as upto
  from places where len(w) > 0 window d as (partition by doc_id, text order by i)
), ends as (
  select a.doc_id, a.text, a.k as k1, min(b.k) as k2 from content a join content b
    on a.doc_id is not distinct from b.doc_id and a.text = b.text and b.k between a.k and a.k + 49 and b.upto - a.upto + a.n >= 50
  group by all
  union
  select b.doc_id, b.text, max(a.k), b.k from content a join content b
    on a.doc_id is not distinct from b.doc_id and a.text = b.text and a.k between b.k - 49 and b.k and b.upto - a.upto + a.n >= 50
  group by b.doc_id, b.text, b.k
), stretches as (
  select e.doc_id, e.text, min(c.i) as first, max(c.i) as last, string_agg(c.line, chr(10) order by c.k) as lines
  from ends e join content c on e.doc_id is not distinct from c.doc_id and e.text = c.text and c.k between k1 and k2
  group by e.doc_id, e.text, k1, k2
), ranked as (
  select *, first_value(doc_id) over w as doc0, first_value(text) over w as text0, first_value(last) over w as last0, row_number() over w as place
  from stretches window w as (partition by lines order by doc_id nulls first, text, first)
), gone as (
  select doc_id, text, first, last from ranked
  where place > 1 and not (doc_id is not distinct from doc0 and text = text0 and first <= last0)
)"""
OP2_SQL = f"""
with {REPEATED_SQL.replace("{documents}", "documents")},
kept as (
  select p.doc_id, p.text, count(*) filter (len(w) > 0) as n, string_agg(p.line, chr(10) order by p.i) as line from places p
  where not exists (from gone g where g.doc_id = p.doc_id and g.text = p.text and p.i between g.first and g.last)
  group by p.doc_id, p.text
), counts as (select doc_id, text, count(*) filter (len(w) > 0) as n from places group by doc_id, text)
select d.doc_id,
  case when exists (from gone g where g.doc_id = d.doc_id and g.text = d.text)
    then case when coalesce(k.n, 0) = 0 then '' else k.line end else d.text end as text,
  coalesce(c.n, 0) as n_lines, coalesce(c.n, 0) - coalesce(k.n, 0) as n_deleted
from documents d left join counts c on c.doc_id = d.doc_id and c.text = d.text left join kept k on k.doc_id = d.doc_id and k.text = d.text
"""
