"""A query per operator over its whole table, and the SQL to compare it with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import (
    alignment,
    bpe,
    jaccard_join,
    license_scan,
    line_quality,
    packing,
    pii_bootstrap,
    preference,
    sentence_spans,
    spelling,
    toxic_crf,
    vector_forest,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _offsets(spans: Column) -> Column:
    return F.concat_ws(
        ",", F.transform(spans, lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string")))
    )


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 ids."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), path).drop("text_key")


@query
def op2_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against the same one with the last reply of its neighbour."""
    pairs = preference.with_swapped_reply(_table(spark, sf_dir, "conversations"))
    return preference.preference_pairs(pairs).drop("chosen", "rejected")


@query
def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the text decoded from them."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_digests(_table(spark, sf_dir, "documents"), path)


@query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document, at 0.8 on five-word runs."""
    return jaccard_join.jaccard_classes(_table(spark, sf_dir, "documents")).drop("text_key", "class_key")


@query
def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as records and read back from the archives."""
    return warc.round_trip(_table(spark, sf_dir, "pages")).drop("url")


@query
def op6_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, and whether it stays once frequent lines are gone."""
    return line_quality.line_rules(_table(spark, sf_dir, "documents"))


@query
def op7_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    found = pii_bootstrap.find_spans(_table(spark, sf_dir, "documents"))

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(number(k).alias(f"n_{name}") for k, name in enumerate(pii_bootstrap.KINDS)),
        F.sha2(pii_bootstrap.as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii_bootstrap.as_text(F.col("spans")).alias("spans"),
    )


@query
def op8_sentence_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that stand in an earlier place."""
    out = sentence_spans.remove_repeated_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_sentences", "n_removed", _offsets(F.col("removed_spans")).alias("removed_spans"), "kept_text")


@query
def op9_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document and its offending offsets."""
    docs = _table(spark, sf_dir, "documents")
    model = toxic_crf.train(docs, _table(spark, sf_dir, "labels"))
    return toxic_crf.score(docs, model).select(
        "doc_id",
        toxic_crf.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= toxic_crf.THRESHOLD, 1).otherwise(0).alias("predicted"),
        _offsets(F.col("spans")).alias("spans"),
    )


@query
def op10_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector, at a cosine of 0.9."""
    return vector_forest.near_vectors(_table(spark, sf_dir, "embeddings"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the more frequent word that each is a variant of."""
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in every document."""
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(_table(spark, sf_dir, "documents"), *paths)


@query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in every document."""
    return license_scan.scan(_table(spark, sf_dir, "documents"))


_WORD = r"'[^\x20\x09-\x0D]+'"

_PREFERENCE = """
with turns as (
  select conv_id, list(struct_pack(role := role, text := text) order by turn, role, text) t
  from (select *, case when conv_id is null then row_number() over () end alone from conversations) group by conv_id, alone
), last_reply as (
  select conv_id, t, list_max(list_filter(list_transform(range(1, len(t) + 1), lambda i: case when t[i].role = 'assistant' then i end), lambda i: i is not null)) k
  from turns
), pairs as (
  select a.conv_id, a.t chosen,
    case when a.k is null then a.t
         else a.t[1:a.k - 1] || (case when b.k is null then [] else [b.t[b.k]] end) || a.t[a.k + 1:len(a.t)] end rejected
  from last_reply a left join last_reply b on b.conv_id = xor(a.conv_id, 1)
), common as (
  select *, coalesce(list_min(list_filter(range(1, least(len(chosen), len(rejected)) + 1),
    lambda i: chosen[i].role is distinct from rejected[i].role or chosen[i].text is distinct from rejected[i].text)) - 1,
    least(len(chosen), len(rejected))) n
  from pairs
), parts as (
  select conv_id, n, chosen[1:n] p, chosen[n + 1:len(chosen)] c, rejected[n + 1:len(rejected)] r from common
), texts as (
  select conv_id, n,
    list_transform(p, lambda x: {turn}) p, list_transform(c, lambda x: {turn}) c, list_transform(r, lambda x: {turn}) r,
    list_transform(c, lambda x: x.role) c_role, list_transform(r, lambda x: x.role) r_role
  from parts
)
select conv_id, n::int as n_prompt_turns, coalesce(array_to_string(p, ''), '') as prompt,
  coalesce(array_to_string(c, ''), '') as chosen_completion, coalesce(array_to_string(r, ''), '') as rejected_completion,
  {chosen} as chosen_mask, {rejected} as rejected_mask
from texts
"""
_TURN = (
    "'<|im_start|>' || replace(coalesce(x.role, ''), '<|', '< |') || chr(10) || "
    "replace(coalesce(x.text, ''), '<|', '< |') || '<|im_end|>' || chr(10)"
)


def _mask(side: str) -> str:
    upto = f"coalesce(list_sum(list_transform({side}[1:i], lambda y: length(y))), 0)"
    begin = f"coalesce(list_sum(list_transform({side}[1:i - 1], lambda y: length(y))), 0)"
    return (
        f"coalesce(array_to_string(list_transform(list_filter(range(1, len({side}) + 1), lambda i: {side}_role[i] = 'assistant'), "
        f"lambda i: ({begin} + 22)::bigint::varchar || ':' || ({upto} - 1)::bigint::varchar), ','), '')"
    )


_JACCARD = rf"""
with recursive worded as (
  select row_number() over () as rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), {_WORD}) w from documents
), sets as (
  select rid, doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end s
  from worded
), sized as (select rid, doc_id, len(s) n, md5(array_to_string(list_sort(s), '|')) k, s from sets),
tokens as (select rid, unnest(s) g from sized),
shared as (select a.rid a, b.rid b, count(*) c from tokens a join tokens b on a.g = b.g and a.rid <> b.rid group by all),
links as materialized (
  select a, b, x.k <> y.k as other, y.k k from shared join sized x on x.rid = a join sized y on y.rid = b
  where 5 * c >= 4 * (x.n + y.n - c)
), reach(a, b) as (select rid, rid from sized union select r.a, l.b from reach r join links l on l.a = r.b),
class as (select a, min(doc_id) class_id from reach join sized on rid = b group by a),
counted as (select a, count(*) n_links, count(distinct case when other then k end) n_text_links, count(*) filter (not other) same from links group by a)
select doc_id, class_id, coalesce(n_links, 0) n_links, coalesce(n_text_links, 0) n_text_links, 1 + coalesce(same, 0) n_copies
from sized join class on class.a = rid left join counted on counted.a = rid
"""

_BASE32 = (
    "array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    "(((instr('0123456789abcdef', substr(h, (5 * k // 4)::int + 1, 1)) - 1) * 16 + "
    "greatest(instr('0123456789abcdef', substr(h || '0', (5 * k // 4)::int + 2, 1)) - 1, 0)) "
    ">> (3 - (5 * k) % 4)::int) % 32 + 1, 1)), '')"
)
_WARC = f"""
with p as (select page_id, coalesce(html, '') html, sha1(coalesce(html, '')) h from pages),
m as (select *, max(page_id) over (partition by html) winner from p)
select page_id, strlen(html)::bigint payload_bytes, {_BASE32} payload_digest,
  case when page_id = winner then 'response' else 'revisit' end record_type,
  case when page_id <> winner then winner end refers_to
from m
"""

_QUALITY = rf"""
with d as (
  select row_number() over () rid, doc_id, source, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), {_WORD}) w from documents
), windows as (
  select rid, i, count(*) over (partition by rid, x) c
  from (select rid, unnest(range(1, len(w) - 1)) i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) x from d)
), repeated as (
  select rid, count(distinct place) n from (select rid, unnest([i, i + 1, i + 2]) place from windows where c > 1) group by rid
), raw_lines as (select rid, source, t, unnest(string_split(t, chr(10))) line from d),
lines as (select *, regexp_extract_all(lower(line), {_WORD}) w, array_to_string(regexp_extract_all(lower(line), {_WORD}), ' ') norm
  from raw_lines where regexp_matches(line, {_WORD})),
dup as (select rid, count(*) - count(distinct line) n from lines group by rid),
hosts as (select source, count(distinct t) n from d group by source),
frequent as (
  select l.source, norm from lines l join hosts h on l.source is not distinct from h.source
  group by l.source, norm, h.n having count(distinct t) > {line_quality.HOST_TEXTS} and count(distinct t) > {line_quality.HOST_SHARE}::double * h.n
), gone as (
  select rid, count(*) n, sum(len(w)) words from lines l join frequent f on l.source is not distinct from f.source and l.norm = f.norm group by rid
), counted as (
  select d.doc_id, len(d.w)::bigint n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols, coalesce(dup.n, 0)::bigint n_dup_lines,
    coalesce(r.n, 0)::bigint n_repeat_words, coalesce(g.n, 0)::bigint n_lines_removed, (len(d.w) - coalesce(g.words, 0))::bigint words_left
  from d left join dup using (rid) left join repeated r using (rid) left join gone g using (rid)
), judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counted)
select *, not base_failed and words_left >= {line_quality.WORDS_LEFT}::double * n_words as kept from judged
"""

_VECTORS = """
with recursive v as (
  select row_number() over () rid, vec_id, list_transform(embedding, lambda x: x::double) e from embeddings
), sound as (
  select * from v where len(e) > 0 and list_bool_and(list_transform(e, lambda x: x is not null and isfinite(x)))
    and list_bool_or(list_transform(e, lambda x: x <> 0))
), links as materialized (
  select a.rid a, b.rid b from sound a join sound b on a.rid <> b.rid and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.9
), reach(a, b) as (select rid, rid from v union select r.a, l.b from reach r join links l on l.a = r.b),
least_id as (select a, min(vec_id) component_id from reach join v on rid = b group by a),
counted as (select a, count(*) n from links group by a)
select vec_id, coalesce(n, 0) n_links, component_id, vec_id = component_id as kept
from v join least_id on least_id.a = rid left join counted on counted.a = rid
"""

_LETTERS = "[A-Za-z\u00c0-\u00ff]+"
_SMALL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# A checksum is folded over the bytes of a run; the table of a byte's remainders comes from its polynomial.
_SPELLING = f"""
with recursive remainder as (
  select list(list_reduce(list_prepend(b, range(8)), lambda x, k: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end) order by b) t
  from (select unnest(range(256)) b)
), runs as (
  select doc_id, unnest(regexp_extract_all({_SMALL.format("coalesce(text, '')")}, '{_LETTERS}')) run from documents
), counted as (select coalesce(doc_id::varchar, '') || ':' || run as named, run, count(*) n from runs group by all),
codes as (
  select run, n, list_prepend(4294967295::bigint, flatten(list_transform(string_split(named, ''), lambda c:
    case when unicode(c) < 128 then [unicode(c)::bigint] else [(192 + unicode(c) // 64)::bigint, (128 + unicode(c) % 64)::bigint] end))) b
  from counted
), summed as (
  select run, n, xor(list_reduce(b, lambda x, y: xor(x // 256, t[xor(x % 256, y) + 1])), 4294967295) h from codes, remainder
), cut as (
  select case when h % {spelling.DROPPED} <> 0 then run
    else substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) end word, n from summed
), words as (
  select word, sum(n)::bigint n from cut where length(word) >= {spelling.LENGTH} group by word having sum(n) >= {spelling.OCCURRENCES}
), less as (
  select word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) x from (select *, unnest(range(1, length(word) + 1)) k from words)
), near as (
  select a.word, b.word near, b.n near_n from less a join less b on a.x = b.x and a.k = b.k and a.word <> b.word
  union select l.word, w.word, w.n from less l join words w on l.x = w.word
  union select w.word, l.word, l.n from less l join words w on l.x = w.word
), best as (
  select word, count(*) n_near, arg_min(near, (-near_n, near)) near, max(near_n) near_n from near group by word
), forms as (
  select words.word, n, coalesce(n_near, 0) n_near, case when near_n >= {spelling.TIMES} * n then near end form,
    case when near_n >= {spelling.TIMES} * n then near_n end form_n
  from words left join best using (word)
), way(word, root) as (
  select word, word from forms union select way.word, forms.form from way join forms on forms.word = way.root where form is not null
), ends as (select way.word, root from way join forms on forms.word = way.root where form is null)
select word, form, root, n, n_near, form_n from forms join ends using (word)
"""

_PLACES = ", ".join(
    f"list_filter(range(0, len(w) - {len(words) - 1}), lambda i: w[i + 1:i + {len(words)}] = {words}) as p{k}"
    for k, words in enumerate(phrase.split() for phrase in license_scan.PHRASES.values())
)
_SCAN = rf"""
with d as (
  select row_number() over () rid, doc_id,
    regexp_extract_all({_SMALL.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents
), placed as (select rid, doc_id, len(w)::bigint n_words, {_PLACES} from d),
notices(id, label, words) as (
  values {", ".join(f"({k}, '{label}', {text.split()})" for k, (label, text) in enumerate(license_scan.TEMPLATES))}
), wanted as (
  select distinct id, label, words[i] || ' ' || words[i + 1] as x from (select *, unnest(range(1, len(words))) i from notices)
), sized as (select id, label, count(*) size from wanted group by all),
pairs as (
  select rid, i - 1 as place, w[i] || ' ' || w[i + 1] as x from (select rid, w, unnest(range(1, len(w))) i from d)
), held as (
  select distinct rid, place // {license_scan.STEP} - back as block, x from pairs, (values (0), (1)) v(back)
  where x in (select x from wanted) and place // {license_scan.STEP} >= back
), shares as (
  select rid, label, count(*) / size as share from held join wanted using (x) join sized using (id, label)
  group by rid, block, id, label, size having count(*) >= ceil({license_scan.THRESHOLD} * size - 1e-9)
), found as (select rid, list(distinct label) more, max(share) most from shares group by rid),
based as (
  select *, list_filter([{", ".join(f"case when len(p{k}) > 0 then '{label}' end" for k, label in enumerate(license_scan.PHRASES))}],
    lambda x: x is not null) base, flatten([{", ".join(f"p{k}" for k in range(len(license_scan.PHRASES)))}]) p from placed
)
select doc_id, n_words, len(p)::bigint n_base, list_min(p) first_word, list_max(p) last_word,
  coalesce(array_to_string(list_sort(base), ','), '') base_labels,
  coalesce(array_to_string(list_sort(list_distinct(base || coalesce(more, []))), ','), '') as labels,
  case when len(p) > 0 then 1.0::double else coalesce(most, 0) end score
from based left join found using (rid)
"""

ORACLES: dict[str, str] = {
    "op2_preference_formatting": _PREFERENCE.format(turn=_TURN, chosen=_mask("c"), rejected=_mask("r")),
    "op4_ngram_jaccard_join": _JACCARD,
    "op5_warc_round_trip": _WARC,
    "op6_line_frequency_rules": _QUALITY,
    "op10_projection_forest": _VECTORS,
    "op11_spelling_variants": _SPELLING,
    "op13_license_scan": _SCAN,
}
