"""Spelling variants of a vocabulary by reduced-alphabet generation.

Two words are near if one inserted, deleted or replaced code point makes one of
the other.  Every letter is hashed to one of a few symbols, so a word becomes a
reduced word, and near words have reduced words that are equal or near
themselves.  The full one-edit neighbourhood of each distinct reduced word is
generated, joined to the reduced vocabulary, and the words behind the reduced
words that meet are compared as they are written.

Nearness is symmetric, so each reduced word generates its neighbourhood towards
the partners that are shorter or have a higher symbol at the replaced place; the
others generate it from their end.  Each pair of reduced words is met once.

A word's form is its near word with the largest count, if that is at least
``ratio`` times the word's own; its root is where the forms end.  Counts grow by
``ratio`` at each step, so the steps are few, and roots are found by doubling.

Defined cases: null and empty words and null counts are left out; repeated words count as one
with the sum of their counts; an empty vocabulary gives an empty result; among
near words of equal counts the smallest in code-point order is the form; other
columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_or_null, stage, table

SYMBOLS = 6            # letters are hashed to so many (at most ten: one digit each)
RATIO = 10
LONG_RUN = "[A-Za-zÀ-ÿ]{7,}"       # greedy, so a whole maximal run


def reduced(word: Column | str, symbols: int = SYMBOLS) -> Column:
    """The word with each code point hashed to a digit below ``symbols``."""
    return F.array_join(F.transform(F.split(word, ""), lambda c: F.pmod(F.ascii(c), F.lit(symbols)).cast("string")), "")


def neighbourhood(r: Column, symbols: int = SYMBOLS) -> Column:
    """Hashes of the reduced words one edit away that are shorter or have a
    higher symbol at one place."""
    places = F.sequence(F.lit(1), F.length(r))
    digits = F.array(*[F.lit(str(i)) for i in range(symbols)])

    def without(i):
        return F.substring(r, F.lit(1), i - 1), F.substring(r, i + 1, F.length(r))

    shorter = F.transform(places, lambda i: F.xxhash64(F.concat(*without(i))))
    higher = F.flatten(F.transform(places, lambda i: F.transform(
        F.filter(digits, lambda d: d > F.substring(r, i, F.lit(1))),
        lambda d: F.xxhash64(F.concat(without(i)[0], d, without(i)[1])))))
    return F.array_distinct(F.concat(shorter, higher))


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, near, near_n) for each pair of near words, once, of ``words``
    with distinct (word, n)."""
    named = words.select("word", "n", reduced("word", symbols).alias("reduced"))
    named = stage(named.withColumn("key", F.xxhash64("reduced")), "reduced")
    classes = named.groupBy("reduced", "key").agg(F.count("*").alias("held"))
    edits = classes.select(F.col("key").alias("a"), F.explode_outer(neighbourhood(F.col("reduced"), symbols)).alias("b"))
    meet = edits.join(named.select(F.col("key").alias("b")).distinct(), "b").select("a", "b")
    meet = meet.unionByName(classes.filter("held > 1").select(F.col("key").alias("a"), F.col("key").alias("b")))
    one = named.select(F.col("key").alias("a"), "word", "n")
    other = named.select(F.col("key").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return (meet.distinct().join(one, "a").join(other, "b")
            .filter("(a <> b or word < near) and abs(length(word) - length(near)) <= 1 and levenshtein(word, near, 1) = 1")
            .select("word", "n", "near", "near_n"))


def follow(forms: DataFrame) -> DataFrame:
    """``forms(word, form)`` -> (word, root): the last word that the forms reach."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stage(now.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = joined.select("word", "root")
        if joined.filter("moved").isEmpty():
            return now


def spelling_variants(counts: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """``counts(word, n)`` -> (word, form, root, n, n_near, form_n)."""
    words = (counts.select(column_or_null(counts, "word", "string").alias("word"), column_or_null(counts, "n", "long").alias("n"))
             .filter("word <> '' and n is not null").groupBy("word").agg(F.sum("n").alias("n")))
    words = stage(words, "words")
    pairs = stage(near_pairs(words, symbols), "near")
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = (both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
            .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")))
    known = words.join(best, "word", "left")
    is_form = F.col("near_n") >= F.col("n") * ratio
    known = stage(known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                               F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")), "forms")
    roots = follow(known.filter("form is not null").select("word", "form"))
    return (known.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def noisy_runs(docs: DataFrame) -> DataFrame:
    """(word): the runs of seven letters or more of whole texts, lower-cased; a
    run whose crc32 with the document's id is divisible by 31 loses one code
    point.  A null id is written as nothing."""
    doc, text = column_or_null(docs, "doc_id", "string"), column_or_null(docs, "text", "string")
    # outer: a plain generator makes Catalyst match every text twice
    runs = docs.select(F.coalesce(doc, F.lit("")).alias("doc"), F.explode_outer(F.regexp_extract_all(text, F.lit(LONG_RUN), F.lit(0))).alias("run"))
    run = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    runs = runs.filter("run is not null").select("doc", run.alias("run"))
    at = F.pmod("h", F.length("run")).cast("int")
    return (runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run")))
            .select(F.when(F.col("h") % 31 == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))))
                    .otherwise(F.col("run")).alias("word"))
            .filter("length(word) >= 7"))


def q_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = noisy_runs(table(spark, sf_dir, "documents")).groupBy("word").agg(F.count("*").alias("n")).filter("n >= 2")
    return spelling_variants(counts)


#: crc32 of a string of one- and two-byte characters, from its polynomial.
_ORACLE = """
with recursive steps as (
  select i, i as c, 0 as k from range(256) t(i)
  union all
  select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from steps where k < 8),
crc_table as (select list(c order by i) as t from steps where k = 8),
runs as (
  select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from documents),
counted as (select coalesce(cast(doc_id as varchar), '') as doc, run, count(*) as times from runs where length(run) >= 7 group by all),
bytes as (
  select run, times, flatten(list_transform(string_split(doc || ':' || run, ''),
    lambda x: case when unicode(x) < 128 then [unicode(x)] else [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] end)) as b
  from counted),
hashed as (
  select run, times, xor(list_reduce(list_prepend(4294967295, list_transform(b, lambda x: x::bigint)),
    lambda acc, x: xor(acc >> 8, t[(xor(acc, x) & 255) + 1])), 4294967295) as h
  from bytes, crc_table),
said as (
  select case when h % 31 = 0 then substring(run, 1, (h % length(run))::int) || substring(run, (h % length(run))::int + 2) else run end as word, times
  from hashed),
words as (select word, sum(times)::bigint as n from said where length(word) >= 7 group by word having sum(times) >= 2),
cuts as (
  select word, n, length(word) as size, i, substring(word, 1, i - 1) || substring(word, i + 1) as rest
  from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
pairs as (
  select a.word, a.n, b.word as near, b.n as near_n from cuts a join cuts b on a.rest = b.rest and a.i = b.i and a.size = b.size and a.word <> b.word
  union
  select a.word, a.n, b.word, b.n from cuts a join words b on a.rest = b.word
  union
  select b.word, b.n, a.word, a.n from cuts a join words b on a.rest = b.word),
best as (
  select word, count(*) as n_near, min({'less': -near_n, 'near': near}) as best from pairs group by word),
forms as (
  select w.word, w.n, coalesce(b.n_near, 0) as n_near,
    case when -b.best.less >= 10 * w.n then b.best.near end as form, case when -b.best.less >= 10 * w.n then -b.best.less end as form_n
  from words w left join best b on w.word = b.word),
roots as (
  select word, word as root, form as next from forms
  union all
  select r.word, f.word, f.form from roots r join forms f on r.next = f.word)
select f.word, f.form, r.root, f.n, f.n_near::bigint as n_near, f.form_n::bigint as form_n
from forms f join roots r on f.word = r.word and r.next is null
"""

QUERIES = {"op13_spelling": q_spelling}
ORACLES = {"op13_spelling": _ORACLE}
