"""The registered queries of the package and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaystone.llm import (
    chat_format,
    decontaminate,
    license_scan,
    line_dedup,
    mixing,
    ngram_join,
    periodic_runs,
    pii,
    quality_classifier,
    quality_rules,
    spelling_variants,
    suffix_dedup,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(_table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of the text that stays."""
    done = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"), whole=True)
    return done.select("row.doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"),
                       F.array_join("dropped", ",").alias("dropped"), F.sha2("text", 256).alias("kept_sha256"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return done.select("row.doc_id", *mixing.MARGINS, F.col("tokens").alias("n_tokens"), "weight", "probability", "kept")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = quality_rules.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       "kept", F.array_join("failed", ",").alias("failed"))


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, labels.where(~held_out(F.col("doc_id"))))
    return quality_classifier.score(docs, model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat_format.read_back(chat_format.chat_format(rows))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_hits, contaminated, items (distinct) and hits (item:start:end:edits)."""
    found = decontaminate.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    hit = lambda h: F.concat_ws(":", h["item_id"], h["start"], h["end"], h["edits"])
    return found.select(
        "doc_id", F.size("hits").cast("long").alias("n_hits"), (F.size("hits") > 0).alias("contaminated"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item_id"]))), ",").alias("items"),
        F.array_join(F.transform("hits", hit), ",").alias("hits"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = pii.find_pii(docs, pii.fit(docs)).withColumn("b", F.filter("spans", lambda s: s["base"]))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda kind: F.filter("b", lambda s: s["kind"] == kind)
    n = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *n, F.sha2(joined("b"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _crc32(text: Column) -> Column:
    return F.crc32(text.cast("binary"))


def looped(docs: DataFrame) -> DataFrame:
    """doc_id, text; where crc32(doc_id) ends in 0 the words from place a on repeat with period p."""
    h = _crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    parts = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    parts = parts.select("*", F.size("words").cast("long").alias("n"))
    parts = parts.select("*", F.when(F.col("n") > 0, F.col("g") % F.col("n")).alias("a"))
    parts = parts.select("*", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    again = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", place(i).cast("int")))
    return parts.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = periodic_runs.periodic_runs(looped(_table(spark, sf_dir, "documents")))
    top = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    done = done.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"),
                       F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length = -F.col("top.l")
    return done.select("doc_id", "n_runs", F.col("top.s").alias("start"), length.alias("length"), F.col("top.p").alias("period"),
                       F.floor(1000 * length / F.col("top.p")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted, n_hits and the distinct terms."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held = lambda c: _crc32(c.cast("string")) % 5 == 0
    model = toxicity.fit(docs, labels.where(~held(F.col("doc_id"))))
    terms = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["term"])))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(held(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("hits").cast("long").alias("n_hits"),
        F.array_join(terms, ",").alias("terms"))


def misspelt(docs: DataFrame) -> DataFrame:
    """(word, n): the words of 7 letters or more that are found twice or more; where 31 divides the crc32 of
    ``<doc_id>:<word>`` the word has lost a letter."""
    runs = spelling_variants.words_of(docs, 7, "doc_id")
    h = _crc32(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("word")))
    cut = (h % F.char_length("word")).cast("int")
    less = F.concat(F.substring("word", F.lit(1), cut), F.substring("word", cut + 2, F.char_length("word")))
    words = runs.select(F.when(h % 31 == 0, less).otherwise(F.col("word")).alias("word")).where(F.char_length("word") >= 7)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = spelling_variants.group_variants(misspelt(_table(spark, sf_dir, "documents")))
    return done.select("word", "form", "root", "n", "n_near", "form_n")


def _quality_sql() -> str:
    """The rules in DuckDB: counts, exact binomial tests by the gamma function, choice of cutoffs and verdicts."""
    values = {"symbols": "n_symbols / greatest(n_words, 1)", "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
              "repeats": "n_repeat_words / greatest(n_words, 1)", "capitals": "n_capitals / greatest(word_chars, 1)",
              "long_words": "word_chars / greatest(n_words, 1)"}
    grid = " union all ".join(f"select '{r}' as rule, unnest({cuts}::double[]) as cutoff, {k} as number"
                              for k, (r, cuts) in enumerate(quality_rules.CUTOFFS.items()))
    each = " union all ".join(f"select doc_id, lang, '{r}' as rule, {v} as value from counted" for r, v in values.items())
    limit = quality_rules.RISK / len(values)
    return rf"""
with texts as (select doc_id, lang, coalesce(text, '') as t from documents),
parts as (
  select doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as l from texts),
windows as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as s
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from parts)),
again as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, s) as n from windows) where n > 1),
repeated as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from again) group by doc_id),
counted as (
  select p.doc_id, lang, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(t) - length(translate(t, '{quality_rules.SYMBOLS}', '')) as n_symbols, len(l) as n_lines,
    len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words,
    length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) as n_capitals
  from parts p left join repeated r on r.doc_id = p.doc_id),
valued as ({each}),
known as (select doc_id, min(quality) as quality from labels where quality in (0, 1) group by doc_id),
grid as ({grid}),
tried as (
  select lang, rule, cutoff, number, count(*) filter (where quality = 1) as n,
    count(*) filter (where quality = 1 and value > cutoff) as wrong,
    count(*) filter (where quality = 0 and value > cutoff) as caught
  from valued join known using (doc_id) join grid using (rule) group by all),
tested as (
  select *, list_sum(list_transform(range(0, wrong + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
    + i * ln({limit}) + (n - i) * ln(1 - {limit})))) as tail,
    (select count(distinct lang) from tried) * {len(values)} as tests
  from tried where caught > 0 and wrong < n * {limit}),
chosen as (
  select lang, rule, cutoff, number from tested where tail <= {quality_rules.DELTA} / tests
  qualify row_number() over (partition by lang, rule order by caught desc, cutoff desc) = 1),
failing as (
  select v.doc_id, string_agg(v.rule, ',' order by c.number) as failed
  from valued v join chosen c on c.lang is not distinct from v.lang and c.rule = v.rule and v.value > c.cutoff
  group by v.doc_id)
select c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and f.failed is null as kept, coalesce(f.failed, '') as failed
from counted c left join failing f on f.doc_id = c.doc_id"""


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_ngram_join, op3_line_dedup, op4_mixing, op5_quality_rules, op6_quality_classifier,
    op7_chat_format, op8_decontaminate, op9_pii, op10_suffix_dedup, op11_periodic_runs, op12_toxicity,
    op13_spelling_variants)}


def _crc32_sql(text: str) -> str:
    """crc32 of a text in DuckDB: its bytes, eight shifts a byte."""
    digit = lambda at: f"(instr('0123456789ABCDEF', substr(hex(encode({text})), {at}, 1)) - 1)"
    byte = f"({digit('2 * i + 1')} * 16 + {digit('2 * i + 2')})::bigint"
    shifts = f"flatten(list_transform(range(strlen({text})), lambda i: [{byte}, 0, 0, 0, 0, 0, 0, 0]))"
    turn = "xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)"
    return f"xor(list_reduce(list_concat([4294967295], {shifts}), lambda c, b: {turn}), 4294967295)"


_RUNS_SQL = rf"""
with parts as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w, {_crc32_sql("doc_id::varchar")} as h
  from documents),
placed as (
  select *, len(w)::bigint as n, h // 10 as g, case when h % 10 = 0 and len(w) > 0 then (h // 10) % len(w) end as a
  from parts),
words as (
  select doc_id, i, w[case when a is null or i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end + 1] as word, n
  from (select *, unnest(range(n)) as i from placed)),
equal as (
  select x.doc_id, x.i, y.i - x.i as q
  from words x join words y on x.doc_id = y.doc_id and x.word = y.word and y.i > x.i and 4 * (y.i - x.i) <= x.n),
stretches as (
  select doc_id, q, min(i) as s, max(i) + q + 1 as e
  from (select *, i - row_number() over (partition by doc_id, q order by i) as k from equal) group by doc_id, q, k),
runs as (
  select doc_id, s, e - s as l, min(q) as q from stretches where e - s >= greatest(6, 4 * q) group by doc_id, s, e),
per_doc as (
  select doc_id, count(*) as n_runs, string_agg(concat(s, ',', l, ',', q, chr(10)), '' order by s, q) as lines,
    arg_min({{'s': s, 'l': l, 'q': q}}, [-l, s, q]) as top
  from runs group by doc_id),
kept as (
  select w.doc_id, string_agg(w.word, ' ' order by w.i) as t
  from words w anti join runs r on r.doc_id = w.doc_id and w.i >= r.s + r.q and w.i < r.s + r.l group by w.doc_id)
select d.doc_id, coalesce(n_runs, 0)::bigint as n_runs, top.s::bigint as start, top.l::bigint as length, top.q::bigint as period,
  (1000 * top.l // top.q)::bigint as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256,
  sha256(coalesce(k.t, '')) as collapsed_sha256
from documents d left join per_doc using (doc_id) left join kept k using (doc_id)"""

_VARIANTS_SQL = rf"""
with recursive found as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) as r from documents),
hashed as (
  select r, m, {_crc32_sql("concat(doc_id, ':', r)")} as h
  from (select doc_id, r, count(*) as m from found where length(r) >= 7 group by all)),
words as (
  select case when h % 31 = 0 then concat(substr(r, 1, h % length(r)), substr(r, h % length(r) + 2)) else r end as word,
    sum(m)::bigint as n from hashed group by 1 having sum(m) >= 2 and length(word) >= 7),
without as (
  select word, n, i, concat(substr(word, 1, i), substr(word, i + 2)) as less
  from (select *, unnest(range(length(word))) as i from words)),
pairs as (
  select a.word, b.word as other, b.n from without a join without b on a.less = b.less and a.i = b.i and a.word <> b.word
  union
  select a.word, b.word, b.n from without a join words b on a.less = b.word
  union
  select b.word, a.word, a.n from without a join words b on a.less = b.word),
near as (
  select word, count(*) as n_near, arg_min({{'w': other, 'n': n}}, {{'n': -n, 'w': encode(other)}}) as best from pairs group by word),
forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when best.n >= 10 * w.n then best.w end as form,
    case when best.n >= 10 * w.n then best.n end as form_n
  from words w left join near using (word)),
chain as (
  select word, word as root, form from forms
  union all
  select c.word, f.word, f.form from chain c join forms f on f.word = c.form)
select f.word, f.form, c.root, f.n::bigint as n, f.n_near::bigint as n_near, f.form_n::bigint as form_n
from forms f join chain c on c.word = f.word and c.form is null"""

SQL = {
    "op7_chat_format": r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized as (
  select *, len(regexp_extract_all(text, '\\|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<\||\|>')) as escapes,
    case role when 'system' then 19 when 'user' then 18 when 'assistant' then 6
      else 11 + length(role) + len(regexp_extract_all(role, '\\|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<\||\|>'))
    end as marks
  from said)
select cast(conv_id as bigint) as conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(text) + escapes + marks) as bigint) as formatted_chars
from sized group by conv_id""",
    "op2_ngram_join": r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
shingled as (
  select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from words),
sets as (select distinct doc_id, s from shingled),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from sets a join sets b on a.s = b.s and a.doc_id < b.doc_id
  group by all),
links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 80 * (x.n + y.n - c)),
both_ways as (select a, b from links union all select b, a from links),
reach as (
  select doc_id as start, doc_id as stop from words
  union
  select r.start, l.b from reach r join both_ways l on l.a = r.stop)
select w.doc_id, cast(coalesce(z.n, 0) as bigint) as n_shingles, r.component_id
from words w left join sizes z using (doc_id)
join (select start, min(stop) as component_id from reach group by start) r on r.start = w.doc_id""",
    "op5_quality_rules": _quality_sql(),
    "op11_periodic_runs": _RUNS_SQL,
    "op13_spelling_variants": _VARIANTS_SQL,
}
