"""One query per operation over the given tables, and its DuckDB SQL where SQL can express it.

Conversations stand for chat samples (source_idx is the rank of conv_id), documents for long answers.
Small settings make every branch occur: an answer has about 130 tokens.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmill.functions import chat, offsets, protected, scores, text
from segmill.jobs import convert, quality, runs, tau
from segmill.jobs.config import SegmentConfig
from segmill.operators import align as joins
from segmill.operators import clusters, ngram, rank, windows
from segmill.sources import jsonl
from segmill.sources.staging import read_table, stage, work_dir
from segmill.streaming import scored_stream as scored

RANKS, LIMIT, SAMPLE, MAX_SAMPLES = 4, 50, 40, 15
MIN_STEP, FIXED, TAU_KEY, QUANTILES = 4, 16, "q_0.2000", (0.05, 0.1, 0.2)
SMALL = SegmentConfig(mode="fixed", fixed_segment_tokens=FIXED, min_step_tokens=MIN_STEP, random_min_tokens=8, random_max_tokens=32, max_length=128, window=64, stride=16)
LONG = SegmentConfig.preset("base", mode="fixed")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# Tables that many queries start from.


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    roles = chat.roles_of_turns(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return rank.with_position(roles, "conv_id")


def usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples(spark, sf_dir).where(chat.is_usable())


def long_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("source_idx"), F.lit("").alias("system_prompt"), F.col("source").alias("question"), F.coalesce("text", F.lit("")).alias("gt_output"), "n_chars")


def token_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_idx, idx, token, confidence, cuttable): a line break is a special token here."""
    scored = ngram.ngram_confidence(usable(spark, sf_dir).select("source_idx", "gt_output"), "source_idx", "gt_output")
    spans = F.array().cast("array<struct<start:int,end:int>>")
    return scored.withColumn("cuttable", protected.is_cuttable(F.col("token"), F.lit(0), F.length("token"), spans, ("\n",)))


_ROLE = "coalesce(arg_min(text, turn) filter (where role = '{}'), '')"
_SAMPLES = f"""samples as (
    select row_number() over (order by conv_id) - 1 as source_idx, * from (
        select conv_id, {_ROLE.format("system")} as system_prompt, {_ROLE.format("user")} as question,
               {_ROLE.format("assistant")} as gt_output
        from conversations group by conv_id)),
usable as (select * from samples where question <> '' and gt_output <> '')"""
_PATTERN = r"(?s) ?\p{L}{1,4}| ?\p{N}{1,3}|\s+|."


def _tokens(source: str, column: str = "gt_output", key: str = "source_idx") -> str:
    return f"""toks as (
    select {key}, idx, token, "end" - length(token) as start, "end" from (
        select {key}, idx, token, cast(sum(length(token)) over (partition by {key} order by idx) as bigint) as "end" from (
            select {key}, unnest(l) as token, unnest(range(len(l))) as idx from (
                select {key}, regexp_extract_all({column}, '{_PATTERN}') as l from {source}))))"""


_FLAGS = """flags as (
    select *, case when usable then len(regexp_extract_all(gt_output, '{p}')) else 0 end as n_tokens from (
        select *, question <> '' and gt_output <> '' as usable from {source})),
counted as (
    select *, n_tokens > {longest} as overlong,
           case when n_tokens <= 0 then 0 when n_tokens <= {w} then 1 else 1 + cast(ceil((n_tokens - {w}) / {s}) as bigint) end as n_windows
    from flags)"""
_COUNTED = _FLAGS.format(p=_PATTERN, source="samples", longest=SMALL.max_length, w=SMALL.window, s=f"{SMALL.stride}.0")
_CONF = f"""pairs as (
    select source_idx, idx, token, coalesce(lag(token) over (partition by source_idx order by idx), chr(2)) as prev from toks),
cnt as (select prev, token, count(*) as c from pairs group by all),
ctx as (select prev, sum(c) as cp from cnt group by prev),
conf as (
    select source_idx, idx, token, cast(c + 1 as double) / cast(cp + v as double) as confidence, token <> chr(10) as cuttable
    from pairs join cnt using (prev, token) join ctx using (prev), (select count(distinct token) as v from cnt)),
vals as (select list_sort(list(confidence)) as l from conf where cuttable),
taus as (
    select format('q_{{:.4f}}', q) as tau_key, q as quantile, l[1 + cast(round_even((len(l) - 1) * q, 0) as bigint)] as tau
    from (select unnest([{", ".join(f"cast({q} as double)" for q in QUANTILES)}]) as q), vals)"""
_SCORED = f"{_SAMPLES}, {_tokens('usable')}, {_CONF}"
_TAU = f"(select tau from taus where tau_key = '{TAU_KEY}')"
_ALNUM = r"[\p{L}\p{N}]"


def _cuts(source: str, column: str = "gt_output", key: str = "source_idx") -> str:
    """cuts: toks with `inside`. A cut is inside a word unless a word or a single character ends there, or ideographs stand on both sides."""
    word = rf"{_ALNUM}+(?:[_-]+{_ALNUM}+)*|(?s:.)"
    return f"""ends as (
    select {key}, cast(sum(length(piece)) over (partition by {key} order by k) as bigint) as "end", true as free from (
        select {key}, unnest(l) as piece, unnest(range(len(l))) as k from (select {key}, regexp_extract_all({column}, '{word}') as l from {source}))),
cuts as materialized (
    select t.{key}, idx, token, "end", free is null and not (regexp_matches(token, '{text.CJK}$') and coalesce(regexp_matches(next, '^{text.CJK}'), false)) as inside
    from (select *, lead(token) over (partition by {key} order by idx) as next from toks) t left join ends using ({key}, "end"))"""


def _valid(piece: str) -> str:
    runs = f"regexp_extract_all({piece}, '{_ALNUM}+')"
    return f"(regexp_matches({piece}, '{_ALNUM}{{3,}}') or (len({runs}) = 1 and length({runs}[1]) >= 2) or regexp_matches({_strip(piece)}, '{_FORMULA_SQL}'))"


def _strip(piece: str) -> str:
    return f"regexp_replace({piece}, '^{text.SPACE}+|{text.SPACE}+$', '', 'g')"


def _fixed(source: str, mask: str, size: int, key: str = "source_idx") -> str:
    """picked(key, boundary): each next token that may end a segment, `size` tokens on. From cuts."""
    return f"""places as materialized (select {key}, list(idx order by idx) as usable, max(n) as n from (
    select {key}, idx, inside, token, count(*) over (partition by {key}) as n from cuts) where not inside and {mask} group by {key}),
rec as (select {key}, -1::bigint as pick from places union all
    select r.{key}, list_filter(p.usable, lambda x: x >= r.pick + {size} and x <= p.n - 2)[1] as pick from rec r join places p using ({key}) where r.pick is not null),
picked as materialized (select {key}, pick as boundary from rec where pick >= 0)"""


def _random(mask: str, config: SegmentConfig, key: str = "source_idx") -> str:
    """picked as _fixed() gives it, with a size drawn for each segment from a hash of seed, row and number. From cuts."""
    low, span = config.random_min_tokens, config.random_max_tokens - config.random_min_tokens + 1
    draw = f"{low} + cast('0x' || substr(md5('{config.random_seed}:' || r.{key} || ':' || r.k), 1, 8) as bigint) % {span}"
    return f"""places as materialized (select {key}, list(idx order by idx) as usable, max(n) as n from (
    select {key}, idx, inside, token, count(*) over (partition by {key}) as n from cuts) where not inside and {mask} group by {key}),
rec as (select {key}, 0::bigint as k, -1::bigint as pick from places union all
    select r.{key}, r.k + 1 as k, list_filter(p.usable, lambda x: x >= r.pick + {draw} and x <= p.n - 2)[1] as pick from rec r join places p using ({key}) where r.pick is not null),
picked as materialized (select {key}, pick as boundary from rec where pick >= 0)"""


def _segments(source: str, min_chars: int, column: str = "gt_output", key: str = "source_idx") -> str:
    """segs(key, k, segment): the text cut after picked tokens, pieces without meaning joined to their neighbours."""
    stands = lambda piece: f"({_valid(piece)} and not (several and length({_strip(piece)}) < 3 and regexp_full_match({_strip(piece)}, '\\p{{L}}+')))"
    return f"""marks as (select p.{key}, list("end" order by idx) as l from picked p join cuts c on c.{key} = p.{key} and idx = boundary where not inside group by p.{key}),
cutting as (select {key}, 0::bigint as pos from {source} union all
    select c.{key}, list_filter(l, lambda x: x >= c.pos + {min_chars})[1] as pos from cutting c join marks using ({key}) where c.pos is not null),
stretches as materialized (select {key}, pos, coalesce(lead(pos) over (partition by {key} order by pos), length({column})) as stop, lead(pos) over (partition by {key} order by pos) is null as tail, {column} as body
    from cutting join {source} using ({key}) where pos is not null),
filled as (select {key}, pos, piece, tail and length(piece) < {min_chars} and row_number() over (partition by {key} order by pos) > 1 as short
    from (select *, substr(body, pos + 1, stop - pos) as piece from stretches) where regexp_matches(piece, '[^{text.SPACE[1:]}')),
pieces as (select {key}, g, string_agg(piece, '' order by pos) as piece from (
    select *, row_number() over (partition by {key} order by pos) - case when short then 1 else 0 end as g from filled) group by {key}, g),
begun as (select *, count(*) over (partition by {key}) > 1 as several, string_agg(piece, '') over (partition by {key} order by g) as whole from pieces),
opening as (select {key}, min(g) as first from begun where {stands("whole")} group by {key}),
labelled as (select {key}, g, piece, sum(case when g > first and {stands("piece")} then 1 else 0 end) over (partition by {key} order by g) as k from begun join opening using ({key})),
segs as (select {key}, cast(k as bigint) as k, string_agg(piece, '' order by g) as segment from labelled group by {key}, k)"""


_FORMULA_SQL = text.FORMULA.replace("'", "''")
_LONG = "longs as (select doc_id as source_idx, '' as system_prompt, source as question, text as gt_output, n_chars from documents where source <> '' and text <> '')"
_LONG_FIXED = f"{_LONG}, {_tokens('longs')}, {_cuts('longs')}, {_fixed('longs', 'true', LONG.fixed_segment_tokens)}, {_segments('longs', LONG.min_step_chars)}"


_DRAWN = f"drawn as (select source_idx from samples order by md5('{tau.SEED}:' || source_idx), source_idx limit {SAMPLE})"

# Sources and sinks.


@query("select conv_id, turn, role, text from conversations where regexp_matches(text, '[^ \\t\\n\\r]')")
def ingest_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turns.where(~text.is_blank(F.col("text")))


@query("select row_number() over (order by conv_id, turn) - 1 as source_idx, conv_id, turn from conversations where regexp_matches(text, '[^ \\t\\n\\r]')")
def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.with_position(ingest_samples(spark, sf_dir).select("conv_id", "turn"), "conv_id", "turn").select("source_idx", "conv_id", "turn")


@query(f"with {_SAMPLES} select source_idx, source_idx as reference_idx, system_prompt, question, gt_output, conv_id from samples")
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples as JSON lines, appended in two writes, and read again; what the schema does not name stays in the raw line."""
    rows, path = stage(samples(spark, sf_dir).orderBy("source_idx")), work_dir(spark)
    for half in (0, 1):
        jsonl.write_jsonl(rows.where(F.col("source_idx") % 2 == half), path)
    found = jsonl.read_jsonl(spark, path, jsonl.REFERENCE)
    named = found.select(*[c for c in found.columns if c not in ("raw", "source_idx")], F.get_json_object("raw", "$.conv_id").cast("long").alias("conv_id"))
    return rank.with_position(named, "reference_idx")


@query(f"with {_SAMPLES} select source_idx, conv_id from samples where source_idx < {LIMIT}")
def limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples(spark, sf_dir).where(F.col("source_idx") < LIMIT).select("source_idx", "conv_id")


@query(f"with {_SAMPLES} select source_idx % {RANKS} as rank, count(*) as n_rows, cast(sum(length(gt_output)) as bigint) as n_chars from samples group by 1")
def rank_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl.rank_report(jsonl.with_rank(samples(spark, sf_dir), RANKS), "gt_output")


@query(f"with {_SAMPLES} select source_idx, source_idx % {RANKS} as rank from samples")
def shard_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl.with_rank(samples(spark, sf_dir), RANKS).select("source_idx", "rank")


@query(f"with {_SAMPLES}, {_DRAWN} select source_idx, (row_number() over (order by source_idx) - 1) % {RANKS} as rank from drawn")
def sample_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = rank.with_position(tau.sample_rows(samples(spark, sf_dir), SAMPLE), "source_idx", name="place")
    return jsonl.with_rank(drawn, RANKS, "place").select("source_idx", "rank")


@query(f"with {_SAMPLES}, u as (select source_idx % {RANKS} as shard, source_idx // 2 as source_idx, conv_id from samples) select row_number() over (order by source_idx, shard, conv_id) - 1 as place, source_idx, shard, conv_id from u")
def merge_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(samples(spark, sf_dir).select((F.col("source_idx") % RANKS).alias("rank"), F.floor(F.col("source_idx") / 2).alias("source_idx"), "conv_id"))
    shards = [rows.where(F.col("rank") == k).drop("rank") for k in range(RANKS)]
    merged = jsonl.merge_shards(shards, "conv_id").withColumn("shard", F.col("shard").cast("long"))
    return rank.with_position(merged, "source_idx", "shard", "conv_id", name="place").select("place", "source_idx", "shard", "conv_id")


@query(f"with {_SAMPLES}, u as (select source_idx % {RANKS} as shard, source_idx // 2 as source_idx, conv_id from samples) select row_number() over (order by source_idx, shard, conv_id) - 1 as place, source_idx, shard, conv_id from u")
def merge_sorted_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of shards that are sorted: ranges of rows are merged where they stand, without a shuffle."""
    rows, paths = stage(samples(spark, sf_dir)), [work_dir(spark) for _ in range(RANKS)]
    for k, path in enumerate(paths):
        own = rows.where(F.col("source_idx") % RANKS == k)
        stage(own.select(F.floor(F.col("source_idx") / 2).alias("source_idx"), "conv_id").orderBy("source_idx"), path)
    merged = jsonl.merge_sorted_shards(spark, paths, "conv_id", ranges=5).withColumn("shard", F.col("shard").cast("long")).withColumn("_order", F.monotonically_increasing_id())
    return rank.with_position(merged, "_order", name="place").select("place", "source_idx", "shard", "conv_id")


# Projections and predicates.


@query(f"with {_SAMPLES} select conv_id, system_prompt, question, gt_output from samples")
def extract_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.roles_of_turns(read_table(spark, sf_dir, "conversations"))


@query(f"with {_SAMPLES} select source_idx, question, gt_output from usable")
def usable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usable(spark, sf_dir).select("source_idx", "question", "gt_output")


@query(f"with {_SAMPLES} select source_idx from samples where question = '' or gt_output = ''")
def skipped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples(spark, sf_dir).where(~chat.is_usable()).select("source_idx")


@query(f"with {_SAMPLES}, {_COUNTED} select source_idx, n_tokens from counted where overlong")
def overlong_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert.flagged(samples(spark, sf_dir), SMALL).where("overlong").select("source_idx", "n_tokens")


@query(f"with {_SAMPLES}, {_COUNTED} select source_idx, n_tokens from counted where usable and not overlong")
def long_policy_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = convert.flagged(samples(spark, sf_dir), SMALL.with_(long_policy="skip"))
    return rows.where("usable and not dropped").select("source_idx", "n_tokens")


_WRAPPED = "'<|begin_of_thought|>' || chr(10) || chr(10) || replace(text, chr(10), ' </think> <think>') || chr(10) || chr(10) || '<|end_of_thought|>'"
_STRINGS = ", ".join(f"'{t}'" for t in protected.PROTECTED)


@query(f"""with d as (select doc_id, {_WRAPPED} as w from documents), p as (select unnest([{_STRINGS}]) as token),
    s as (select doc_id, token, string_split(w, token) as parts from d, p where contains(w, token)),
    h as (select doc_id, token, parts, unnest(range(1, len(parts))) as k from s)
    select doc_id, cast(list_sum(list_transform(parts[1:k], lambda x: length(x))) + (k - 1) * length(token) as bigint) as start,
           cast(list_sum(list_transform(parts[1:k], lambda x: length(x))) + k * length(token) as bigint) as "end", token
    from h""")  # fmt: skip
def protected_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    inner = F.replace(F.col("text"), F.lit("\n"), F.lit(" </think> <think>"))
    wrapped = docs.select("doc_id", F.concat(F.lit("<|begin_of_thought|>\n\n"), inner, F.lit("\n\n<|end_of_thought|>")).alias("w"))
    spans = wrapped.select("doc_id", F.explode(protected.protected_spans(F.col("w"))).alias("s"))
    return spans.select("doc_id", F.col("s.start").cast("long").alias("start"), F.col("s.end").cast("long").alias("end"), F.col("s.token").alias("token"))


#: All words of three of six letters: many strings that overlap each other.
_MANY = ["".join(w) for w in product("aeinst", repeat=3)]


@query(f"""with {_SAMPLES}, p as (select unnest({_MANY}) as token), s as (select source_idx, token, string_split(gt_output, token) as parts from usable, p where contains(gt_output, token)),
    h as (select source_idx, token, parts, unnest(range(1, len(parts))) as k from s)
    select source_idx, cast(list_sum(list_transform(parts[1:k], lambda x: length(x))) + (k - 1) * 3 as bigint) as start, token from h""")  # fmt: skip
def many_protected_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = usable(spark, sf_dir).select("source_idx", F.explode(protected.protected_spans(F.col("gt_output"), _MANY)).alias("s"))
    return spans.select("source_idx", F.col("s.start").cast("long").alias("start"), "s.token")


@query(f"""with {_SAMPLES}, wrapped as (select source_idx, '<think>' || gt_output || '</think>' as w from usable), {_tokens("wrapped", "w")},
    size as (select source_idx, max("end") as n from toks group by source_idx)
    select source_idx, idx, not (start < 7 or "end" > n - 8) as cuttable from toks join size using (source_idx)""")  # fmt: skip
def cuttable_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(spark, sf_dir).select("source_idx", F.concat(F.lit("<think>"), "gt_output", F.lit("</think>")).alias("w"))
    return protected.cuttable_rows(rows, "source_idx", "w")


@query(f"with {_SAMPLES}, {_tokens('usable')}, {_cuts('usable')} select source_idx, idx, \"end\", inside from cuts")
def inside_word_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.inside_word_ends(usable(spark, sf_dir), "source_idx", "gt_output")


@query(f"""with p as (select distinct unnest(string_split(text, ' ')) as piece from documents)
    select piece, {_valid("piece")} as valid from p""")  # fmt: skip
def valid_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = read_table(spark, sf_dir, "documents").select(F.explode(F.split("text", " ", -1)).alias("piece")).distinct()
    return pieces.select("piece", text.is_valid_segment(F.col("piece")).alias("valid"))


# Text, records and scores.


@query("select doc_id, k, piece from (select doc_id, unnest(range(len(l))) as k, unnest(l) as piece from (select doc_id, list_filter(list_transform(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)), lambda x: regexp_replace(x, '^" + text.SPACE + "+|" + text.SPACE + "+$', '', 'g')), lambda x: x <> '') as l from documents))")
def split_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n")).alias("t"))
    pieces = docs.select("doc_id", F.posexplode(text.split_paragraphs(F.col("t"))).alias("k", "piece"))
    return pieces.withColumn("k", F.col("k").cast("long"))


@query(f"with {_SAMPLES}, {_tokens('usable')} select source_idx, idx, token, start, \"end\" from toks")
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.token_rows(usable(spark, sf_dir), "source_idx", "gt_output")


@query(f"with l as (select doc_id, regexp_extract_all(text, '{_PATTERN}') as l from documents) select doc_id, len(l) as n_tokens, cast(coalesce(list_sum(list_transform(l, lambda x: length(x))), 0) as bigint) as n_chars from l")
def tokenize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = read_table(spark, sf_dir, "documents").select("doc_id", text.tokens(F.col("text")).alias("l"))
    size = F.aggregate("l", F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    return listed.select("doc_id", F.size("l").cast("long").alias("n_tokens"), size.alias("n_chars"))


@query(f"""with {_SAMPLES}, r as (select source_idx, gt_output, case when system_prompt <> '' then '[system]' || chr(10) || system_prompt || chr(10) else '' end
    || '[user]' || chr(10) || question || chr(10) || '[assistant]' || chr(10) as prefix_text from usable)
    select source_idx, prefix_text, prefix_text || gt_output as full_text from r""")  # fmt: skip
def render_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix, full = chat.render_prompt()
    return usable(spark, sf_dir).select("source_idx", prefix.alias("prefix_text"), full.alias("full_text"))


_PARTS = "list_filter(list_transform(string_split(COLUMN, chr(10) || chr(10)), lambda x: regexp_replace(x, '^" + text.SPACE + "+|" + text.SPACE + "+$', '', 'g')), lambda x: x <> '')"


@query(f"""with {_SAMPLES} select source_idx, system_prompt, question, gt_output, array_to_string({_PARTS.replace("COLUMN", "question")}, '|~|') as question_list,
    array_to_string({_PARTS.replace("COLUMN", "gt_output")}, '|~|') as thoughts_list, array_to_string({_PARTS.replace("COLUMN", "system_prompt")}, '|~|') as system_list, true as add_eos from usable""")  # fmt: skip
def training_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = usable(spark, sf_dir).select(*chat.training_record())
    return records.select("source_idx", "system_prompt", "question", "gt_output", *[F.array_join(c, "|~|").alias(c) for c in ("question_list", "thoughts_list", "system_list")], "add_eos")


def _logprobs(rows: DataFrame) -> DataFrame:
    """A made log-probability per character of the first answer: derived from the sample itself."""
    size = F.length("gt_output") % 7 + 3
    value = lambda i: F.when(i % 5 == 4, F.lit(None).cast("double")).otherwise(-((F.col("source_idx") * 31 + i * 17) % 120).cast("double"))
    return rows.withColumn("logprobs", F.transform(F.sequence(F.lit(0).cast("long"), size.cast("long") - 1), value)).withColumn("n_tokens", (F.length("question") % 9 + 2).cast("long"))


_LOGPROBS = "lp as (select *, list_transform(range(length(gt_output) % 7 + 3), lambda i: case when i % 5 = 4 then null else -cast((source_idx * 31 + i * 17) % 120 as double) end) as logprobs, length(question) % 9 + 2 as n_tokens from usable)"


@query(f"""with {_SAMPLES}, {_LOGPROBS}, r as (select source_idx, logprobs, unnest(range(n_tokens)) as idx from lp)
    select source_idx, idx, round(exp(greatest(coalesce(logprobs[idx + 1], -100), -100)), 12) as confidence from r""")  # fmt: skip
def logprob_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _logprobs(usable(spark, sf_dir))
    listed = rows.select("source_idx", F.posexplode(scores.logprob_confidence(F.col("logprobs"), F.col("n_tokens"))).alias("idx", "c"))
    return listed.select("source_idx", F.col("idx").cast("long").alias("idx"), F.round("c", 12).alias("confidence"))


@query(f"""with {_SAMPLES}, {_LOGPROBS}, r as (select source_idx, logprobs, len(logprobs) as n, n_tokens as start, unnest(range(0, 12)) as position,
        len(logprobs) + case when source_idx % 2 = 0 then n_tokens else 1 end as whole from lp)
    select source_idx, position, case when n = greatest(whole - start, 0) and position - start >= 0 and position - start < n then logprobs[position - start + 1]
        when position < n then logprobs[position + 1] when position - start >= 0 and position - start < n then logprobs[position - start + 1] end as logprob from r""")  # fmt: skip
def align_logprobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _logprobs(usable(spark, sf_dir)).withColumn("whole", F.size("logprobs") + F.when(F.col("source_idx") % 2 == 0, F.col("n_tokens")).otherwise(1))
    rows = rows.withColumn("position", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(11).cast("long"))))
    return rows.select("source_idx", "position", scores.logprob_at(F.col("logprobs"), F.col("position"), F.col("whole"), F.col("n_tokens")).alias("logprob"))


@query(f"with {_SCORED} select source_idx, idx, token, confidence from conf")
def ngram_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scores(spark, sf_dir).drop("cuttable")


@query(f"""with {_SAMPLES}, {_COUNTED}, w as (select source_idx, n_tokens as n, n_windows as k, unnest(range(n_windows)) as window_idx from counted)
    select source_idx, window_idx, window_idx * {SMALL.stride} as start, least(window_idx * {SMALL.stride} + {SMALL.window}, n) as "end",
           case when window_idx = 0 then 0 else {SMALL.window - SMALL.stride} end as fresh_start from w""")  # fmt: skip
def scoring_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = convert.flagged(samples(spark, sf_dir), SMALL)
    return rows.select("source_idx", F.inline(scores.scoring_windows(F.col("n_tokens"), SMALL.window, SMALL.stride)))


@query(f"with {_SAMPLES}, {_COUNTED} select source_idx, n_tokens, n_windows from counted")
def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert.flagged(samples(spark, sf_dir), SMALL).select("source_idx", "n_tokens", "n_windows")


# A scorer over windows. The one here knows a token and the one before it (of a first one: the prompt's last character).


def toy_scorer():
    def score(found):
        for w in found:
            before = [w.prefix[-1:], *w.tokens]
            yield [(len(w.tokens[i]) * 29 + len(before[i]) * 13 + ord(w.tokens[i][0]) % 31) % 101 / 128 for i in range(w.fresh_start, len(w.tokens))]

    return score


_TOY = f"""conf as (select source_idx, idx, token, (length(token) * 29 + coalesce(length(lag(token) over (partition by source_idx order by idx)), 1) * 13 + unicode(token) % 31) % 101 / 128.0::double as confidence,
        token <> chr(10) as cuttable from toks),
    vals as (select list_sort(list(confidence)) as l from conf semi join drawn using (source_idx) where cuttable),
    taus as (select format('q_{{:.4f}}', q) as tau_key, q as quantile, l[1 + cast(round_even((len(l) - 1) * q, 0) as bigint)] as tau from (select unnest([{", ".join(f"cast({q} as double)" for q in QUANTILES)}]) as q), vals)"""


@query(f"with {_SAMPLES}, {_DRAWN}, {_tokens('usable')}, {_TOY} select source_idx, idx, confidence from conf")
def windowed_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of windows of 64 tokens, 16 of them fresh, as one array per answer."""
    found = windows.score_answers(samples(spark, sf_dir), toy_scorer, SMALL.window, SMALL.stride)
    rows = found.select("source_idx", F.posexplode("confidences").alias("idx", "confidence"))
    return rows.withColumn("idx", F.col("idx").cast("long"))


@query(f"""with {_SAMPLES}, {_COUNTED}, w as (select source_idx, unnest(range(n_windows)) as window_idx, n_tokens as n from counted)
    select source_idx, window_idx, least({SMALL.window}, n - window_idx * {SMALL.stride}) as n_tokens,
        case when window_idx = 0 then least({SMALL.window}, n) else least({SMALL.window}, n - window_idx * {SMALL.stride}) - {SMALL.window - SMALL.stride} end as n_fresh from w""")  # fmt: skip
def scored_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each window of an answer holds, and how much of it is scored."""
    rows = windows.window_rows(samples(spark, sf_dir), SMALL.window, SMALL.stride)
    size = F.size("tokens").cast("long")
    return rows.select("source_idx", "window_idx", size.alias("n_tokens"), (size - F.col("fresh_start")).alias("n_fresh"))


# Joins.

_SHIFTED = "ref as (select source_idx, case when source_idx % 10 = 7 then source_idx + 1 when source_idx % 10 = 3 then null else source_idx end as reference_idx, length(gt_output) as n_chars from samples)"


def _reference(rows: DataFrame) -> DataFrame:
    stated = F.when(F.col("source_idx") % 10 == 7, F.col("source_idx") + 1).when(F.col("source_idx") % 10 != 3, F.col("source_idx"))
    return rows.select("source_idx", stated.alias("reference_idx"), F.length("gt_output").cast("long").alias("n_chars"))


@query(f"with {_SAMPLES}, {_SHIFTED} select s.source_idx, reference_idx, n_chars from samples s left join ref using (source_idx)")
def align_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(samples(spark, sf_dir))
    return joins.align(rows, _reference(rows))


@query(f"with {_SAMPLES}, {_SHIFTED} select source_idx, reference_idx from ref where reference_idx <> source_idx")
def alignment_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.mismatches(align_reference(spark, sf_dir)).select("source_idx", "reference_idx")


@query(f"with {_SAMPLES}, {_DRAWN} select source_idx, question from samples semi join drawn using (source_idx)")
def sampled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(samples(spark, sf_dir))
    return rows.join(F.broadcast(tau.sample_rows(rows, SAMPLE)), "source_idx", "left_semi").select("source_idx", "question")


@query(f"with {_SAMPLES} select source_idx, conv_id from samples where source_idx % 3 <> 0")
def incremental_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(samples(spark, sf_dir).select("source_idx", "conv_id"))
    return joins.not_done(rows, rows.where("source_idx % 3 = 0"))


@query(f"with {_SCORED} select source_idx, count(*) as n_scores, round(min(confidence), 12) as least, round(max(confidence), 12) as most from conf group by source_idx")
def attach_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(spark, sf_dir).select("source_idx", F.size(text.tokens(F.col("gt_output"))).alias("n_tokens"))
    joined = joins.attach_scores(rows, ngram.confidence_arrays(token_scores(spark, sf_dir), "source_idx"))
    return joined.select("source_idx", F.size("confidences").cast("long").alias("n_scores"), F.round(F.array_min("confidences"), 12).alias("least"), F.round(F.array_max("confidences"), 12).alias("most"))


# Sampling and order statistics.


@query(f"with {_SAMPLES}, {_DRAWN} select source_idx from drawn")
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tau.sample_rows(samples(spark, sf_dir), SAMPLE)


@query(f"with {_SAMPLES}, {_DRAWN} select source_idx from drawn order by source_idx limit {MAX_SAMPLES}")
def max_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_rows(spark, sf_dir).orderBy("source_idx").limit(MAX_SAMPLES)


@query(f"with {_SCORED} select tau_key, quantile, tau from taus")
def tau_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tau.estimate_tau(token_scores(spark, sf_dir), QUANTILES)


@query(f"""with {_SCORED}, n as (select count(*) as n from conf where confidence > 1)
    select format('q_{{:.4f}}', q) as tau_key, q as quantile, case when n > 0 then 1.0::double end as tau from (select unnest([{", ".join(f"cast({q} as double)" for q in QUANTILES)}]) as q), n""")  # fmt: skip
def tau_of_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No confidence is over 1: every candidate is null."""
    return tau.estimate_tau(token_scores(spark, sf_dir).where("confidence > 1"), QUANTILES)


@query(f"with {_SCORED} select tau_key, quantile, tau from taus")
def tau_by_bracket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a sketch's brackets: the pool of confidences is not shuffled."""
    return tau.estimate_tau(stage(token_scores(spark, sf_dir)), QUANTILES, bracket=True)


@query()
def position_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The draw of Python's generator, which SQL cannot repeat."""
    return tau.sample_rows(samples(spark, sf_dir), SAMPLE, positions=True)


@query(f"with {_SCORED} select tau_key, tau from taus where tau_key = '{TAU_KEY}'")
def pick_tau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tau_candidates(spark, sf_dir).where(F.col("tau_key") == TAU_KEY).select("tau_key", "tau")


def _low(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(token_scores(spark, sf_dir))
    return clusters.low_confidence(rows, tau.pick_tau(tau.estimate_tau(rows, QUANTILES), TAU_KEY))


_LOW = f"low as (select *, idx - row_number() over (partition by source_idx order by idx) as island from conf where cuttable and confidence < {_TAU})"


@query(f"with {_SCORED}, {_LOW} select source_idx, idx, confidence from low")
def low_confidence_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _low(spark, sf_dir).select("source_idx", "idx", "confidence")


@query(f"with {_SCORED}, {_LOW} select source_idx, min(idx) as first_idx, max(idx) as last_idx, count(*) as n from low group by source_idx, island")
def low_conf_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = clusters.clusters(_low(spark, sf_dir)).groupBy("source_idx", "island")
    return runs.agg(F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.count(F.lit(1)).alias("n")).drop("island")


@query(f"with {_SCORED}, {_LOW} select source_idx, idx, row_number() over (partition by source_idx, island order by confidence, idx) as turn from low")
def cluster_minima(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.try_order(clusters.clusters(_low(spark, sf_dir))).select("source_idx", "idx", "turn")


# Segmentation.

_SHORT = SMALL.with_(mode="threshold", max_length=8192, special_tokens=("\n",))
_PICKED = f"""{_LOW}, {_cuts("usable")},
places as materialized (select source_idx, list(idx order by idx) as usable from cuts where token <> chr(10) and not inside group by source_idx),
runs as materialized (select source_idx, row_number() over (partition by source_idx order by min(idx)) as k, list(idx order by confidence, idx) as tries from low group by source_idx, island),
rec as (select source_idx, 0::bigint as k, -1::bigint as last, null::bigint as pick from usable union all
    select source_idx, k, coalesce(pick, last) as last, pick from (
        select r.source_idx, i.k, r.last, coalesce(list_filter(i.tries, lambda x: x - r.last >= {MIN_STEP} and list_contains(p.usable, x))[1],
            list_filter(flatten(list_transform(i.tries, lambda x: [x + 1, x - 1, x + 2, x - 2, x + 3, x - 3])), lambda x: x - r.last >= {MIN_STEP} and list_contains(p.usable, x))[1]) as pick
        from rec r join runs i on i.source_idx = r.source_idx and i.k = r.k + 1 join places p on p.source_idx = r.source_idx)),
picked as materialized (select source_idx, pick as boundary from rec where pick is not null)"""
_THRESHOLD = f"{_SCORED}, {_PICKED}"
_THRESHOLD_SEGMENTS = f"{_THRESHOLD}, {_segments('usable', SMALL.min_step_chars)}"


@query(f"with recursive {_SAMPLES}, {_tokens('usable')}, {_cuts('usable')}, {_fixed('usable', 'true', FIXED)} select source_idx, boundary from picked")
def boundaries_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = convert.convert(samples(spark, sf_dir), SMALL.with_(max_length=8192))
    return rows.select("source_idx", F.explode("boundaries").alias("boundary"))


@query(f"with recursive {_THRESHOLD} select source_idx, boundary from picked")
def boundaries_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_threshold_rows(spark, sf_dir).select("source_idx", F.explode("boundaries").alias("boundary"))


def convert_threshold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = stage(token_scores(spark, sf_dir))
    chosen = tau.pick_tau(tau.estimate_tau(tokens, QUANTILES), TAU_KEY)
    return convert.convert(samples(spark, sf_dir), _SHORT.with_(tau=chosen), ngram.confidence_arrays(tokens, "source_idx"))


_HASHED = SMALL.with_(mode="random", random_generator="hash")
_LONG_HASHED = LONG.with_(mode="random", random_generator="hash")


@query(f"with recursive {_SAMPLES}, {_tokens('usable')}, {_cuts('usable')}, {_random('true', _HASHED)} select source_idx, boundary from picked")
def boundaries_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = convert.convert(samples(spark, sf_dir), _HASHED.with_(max_length=8192))
    return rows.select("source_idx", F.explode("boundaries").alias("boundary"))


@query()
def boundaries_mersenne(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with Python's generator, which SQL cannot repeat."""
    rows = convert.convert(samples(spark, sf_dir), SMALL.with_(mode="random"))
    return rows.select("source_idx", F.explode("boundaries").alias("boundary"))


@query(f"with recursive {_LONG_FIXED} select source_idx, k, segment from segs")
def convert_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.segment_rows(convert.convert(long_samples(spark, sf_dir), LONG))


@query(f"""with recursive {_SAMPLES}, {_tokens("usable")}, {_cuts("usable")}, {_fixed("usable", "true", FIXED)}, {_segments("usable", SMALL.min_step_chars)}
    select source_idx, k, segment from segs where source_idx % 3 = 0""")  # fmt: skip
def convert_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(samples(spark, sf_dir))
    inputs = rows.select("source_idx").where("source_idx % 3 = 0")  # a run over some rows of the reference
    reference = rows.withColumn("reference_idx", F.when(F.col("source_idx") % 2 == 0, F.col("source_idx")))
    return quality.segment_rows(convert.convert_aligned(inputs, reference, SMALL.with_(max_length=8192)))


@query(f"""with recursive {_SAMPLES}, {_tokens("usable")}, {_cuts("usable")}, {_fixed("usable", "true", FIXED)}, {_segments("usable", SMALL.min_step_chars)},
    joined as (select source_idx, count(*) as n_segments from segs group by source_idx)
    select source_idx, conv_id, system_prompt, question, length(gt_output) as n_chars, coalesce(n_segments, 0) as n_segments from usable left join joined using (source_idx)""")  # fmt: skip
def inherited_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of the reference but its segments passes through a conversion."""
    rows = stage(samples(spark, sf_dir).withColumn("n_chars", F.length("gt_output").cast("long")).withColumn("thoughts_list", F.array(F.lit("old"))))
    found = convert.convert_aligned(rows.select("source_idx"), rows, SMALL.with_(max_length=8192))
    return found.select("source_idx", "conv_id", "system_prompt", "question", "n_chars", F.size("thoughts_list").cast("long").alias("n_segments"))


@query(f"with recursive {_LONG}, {_tokens('longs')}, {_cuts('longs')}, {_random('true', _LONG_HASHED)}, {_segments('longs', LONG.min_step_chars)} select source_idx, k, segment from segs")
def convert_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.segment_rows(convert.convert(long_samples(spark, sf_dir), _LONG_HASHED))


@query(f"with recursive {_THRESHOLD_SEGMENTS} select source_idx, k, segment from segs")
def convert_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.segment_rows(convert_threshold_rows(spark, sf_dir))


@query(f"with recursive {_SAMPLES}, {_DRAWN}, {_tokens('usable')}, {_TOY}, {_PICKED}, {_segments('usable', SMALL.min_step_chars)} select source_idx, k, segment from segs")
def convert_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's scorer over windows, from the sample that gives tau to the segments."""
    rows = stage(samples(spark, sf_dir))
    return quality.segment_rows(convert.scored_run(rows, _SHORT, toy_scorer, SAMPLE, tau.SEED, QUANTILES, TAU_KEY))


# Tokens in context: the prompt here ends in a word, so that tokens do straddle its edge.

IN_CONTEXT = offsets.InContext(offsets.with_offsets(text.tokens), lambda: (F.col("question"), F.concat("question", "gt_output")))
_CHAT = """chat as (select source_idx, question || gt_output as gt_output, length(question) as edge from usable)"""
_SPANS = f"""{_CHAT}, {_tokens("chat").replace("toks as", "every as", 1)},
    toks as (select source_idx, row_number() over (partition by source_idx order by idx) - 1 as idx, token, greatest(start - edge, 0) as start, "end" - edge as "end"
        from every join chat using (source_idx) where "end" > edge)"""


@query(f"with {_SAMPLES}, {_SPANS} select source_idx, idx, token, start, \"end\" from toks")
def tokens_in_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(spark, sf_dir).select("source_idx", F.posexplode(IN_CONTEXT.spans()).alias("idx", "t"))
    return rows.select("source_idx", F.col("idx").cast("long").alias("idx"), "t.token", F.col("t.start").cast("long").alias("start"), F.col("t.end").cast("long").alias("end"))


@query(f"with recursive {_SAMPLES}, {_SPANS}, {_cuts('usable')}, {_fixed('usable', 'true', FIXED)}, {_segments('usable', SMALL.min_step_chars)} select source_idx, k, segment from segs")
def convert_in_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.segment_rows(convert.convert(samples(spark, sf_dir), SMALL.with_(max_length=8192), tokenizer=IN_CONTEXT))


# Records as their own text, and committed runs.

_FIXED_SEGMENTS = f"{_SAMPLES}, {_tokens('usable')}, {_cuts('usable')}, {_fixed('usable', 'true', FIXED)}, {_segments('usable', SMALL.min_step_chars)}"
_LINE = """'{"weight": 1.50, "gt_output": ' || to_json(gt_output) || ', "thoughts_list": ' || THOUGHTS || ', "question": ' || to_json(question) || ' , "conv": {"id": [' || conv_id || ', null]}' || END || '}'"""


@query(f"""with recursive {_FIXED_SEGMENTS}, l as (select source_idx, '[' || string_agg(to_json(segment), ',' order by k) || ']' as thoughts from segs group by source_idx)
    select source_idx, {_LINE.replace("THOUGHTS", "coalesce(thoughts, '[]')").replace("END", "', " + '"source_idx": ' + "' || source_idx")} as value from usable left join l using (source_idx)""")  # fmt: skip
def jsonl_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with fields that no schema names: read, converted and written, they differ in thoughts_list alone."""
    rows, path, target = stage(samples(spark, sf_dir)), work_dir(spark), work_dir(spark)
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(F.col(c).alias("x"))), r'(?s)^\{"x":(.*)\}$', 1)
    old = F.concat(F.lit('{"weight": 1.50, "gt_output": '), quoted("gt_output"), F.lit(', "thoughts_list": ["old", {"x": "}"}], "question": '), quoted("question"), F.lit(' , "conv": {"id": ['), F.col("conv_id").cast("string"), F.lit(", null]}}"))
    rows.orderBy("source_idx").select(old.alias("value")).write.text(path)
    jsonl.write_records(convert.convert(jsonl.read_jsonl(spark, path, jsonl.REFERENCE), SMALL.with_(max_length=8192)), target)
    written = spark.read.text(target)
    return written.select(F.get_json_object("value", "$.source_idx").cast("long").alias("source_idx"), "value")


def _two_runs(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a run of two ranks, one that was lost before its manifest, and one of the rest; rows of one segment are dropped."""
    rows, target, config = stage(samples(spark, sf_dir)), work_dir(spark), SMALL.with_(long_policy="skip")
    several = F.size("thoughts_list") > 1
    runs.convert_run(rows, config, target, RANKS, ranks=(0, 1), keep=several)
    runs.write_run(runs.converted_rows(rows, config, RANKS), target, 1)
    runs.convert_run(rows, config, target, RANKS, keep=several)
    return target


_RUN = f"case when source_idx % {RANKS} < 2 then 0 else 1 end as run, source_idx % {RANKS} as rank"
_SEEN = f"""{_FIXED_SEGMENTS}, {_COUNTED}, joined as (select source_idx, count(*) as n_segments from segs group by source_idx),
    seen as (select *, {_RUN}, usable and not overlong as scored, usable and not overlong and coalesce(n_segments, 0) > 1 as written from counted left join joined using (source_idx))"""


@query(f"""with recursive {_SEEN} select run, rank, count(*) as rows_seen, count(*) filter (scored) as rows_scored, count(*) filter (written) as rows_written,
    count(*) filter (scored and not written) as rows_dropped, count(*) filter (written) as output_rows, true as finished, true as consistent from seen group by run, rank""")  # fmt: skip
def committed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.audit_runs(spark, _two_runs(spark, sf_dir))


@query(f"with recursive {_SEEN} select source_idx, conv_id, run, rank, n_segments from seen where written")
def resumed_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What committed runs hold: each row once, whatever was lost between."""
    return runs.read_output(spark, _two_runs(spark, sf_dir)).select("source_idx", "conv_id", "run", "rank", F.size("thoughts_list").cast("long").alias("n_segments"))


@query(f"""with recursive {_SEEN} select run, rank, count(*) as rows_seen, count(*) filter (scored) as rows_scored, count(*) filter (written) as rows_written, count(*) filter (not usable) as rows_skipped,
    count(*) filter (overlong) as num_overlong, count(*) filter (scored and not written) as rows_dropped, cast(coalesce(sum(n_tokens) filter (scored), 0) as bigint) as token_count,
    cast(coalesce(sum(n_windows) filter (scored), 0) as bigint) as window_count, max(source_idx) as last_source_idx from seen group by run, rank""")  # fmt: skip
def run_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.manifest(spark, _two_runs(spark, sf_dir)).drop("world_size", "finished", "settings")


_WAIT = 30
_ARRIVED = f"""{_SAMPLES}, {_DRAWN}, {_tokens('usable')}, {_TOY}, n as (select source_idx, count(*) as n_tokens from toks group by source_idx), {_PICKED}, {_segments('usable', SMALL.min_step_chars)},
    joined as (select source_idx, count(*) as n_segments from segs group by source_idx)"""


@query(f"""with recursive {_ARRIVED} select source_idx, case when question = '' or gt_output = '' then 'skipped' when source_idx % 5 = 2 or source_idx % 7 = 3 then 'unscored' when source_idx % 11 = 4 then 'wrong' else 'written' end as status,
    case when question = '' or gt_output = '' or source_idx % 5 = 2 or source_idx % 7 = 3 or source_idx % 11 = 4 then -1 else coalesce(n_segments, 0) end as n_segments from samples left join joined using (source_idx)""")  # fmt: skip
def scored_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples and scores as streams of files: some scores never come, some too late for their sample, some twice, some for other tokens."""
    rows = stage(samples(spark, sf_dir))
    minute = lambda k: F.timestamp_seconds(F.lit(1_700_000_000).cast("long") + 60 * k)
    scores = stage(windows.score_answers(rows, toy_scorer, SMALL.window, SMALL.stride))
    drawn = tau.sample_rows(rows, SAMPLE)
    chosen = tau.pick_tau(tau.estimate_tau(windows.confidence_rows(rows.join(drawn, "source_idx", "left_semi"), scores, ("\n",)), QUANTILES), TAU_KEY)
    left, right, target, end = work_dir(spark), work_dir(spark), work_dir(spark), 100_000
    stage(rows.withColumn("at", minute(F.col("source_idx") % 10)), left)
    late = F.when(F.col("source_idx") % 7 == 3, _WAIT + 11).otherwise(F.col("source_idx") % 3)  # minutes after the first sample of all
    sent = scores.where("source_idx % 5 <> 2").withColumn("confidences", F.when(F.col("source_idx") % 11 == 4, F.slice("confidences", 2, 1 << 30)).otherwise(F.col("confidences")))
    stage(sent.withColumn("at", minute(late)).unionByName(sent.where("source_idx % 2 = 0 and source_idx % 7 <> 3").withColumn("at", minute(late))), right)
    done = spark.range(1).select(F.lit(-1).cast("long").alias("source_idx"), minute(F.lit(end)).alias("at"))  # a row of a later day moves the watermark on
    for path, schema in ((left, spark.read.parquet(left).schema), (right, spark.read.parquet(right).schema)):
        done.select(*[F.col(f.name) if f.name in done.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).write.mode("append").parquet(path)
    read = lambda path: spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    found = scored.convert_streams(read(left), read(right), _SHORT.with_(tau=chosen), f"{_WAIT} minutes", "10 minutes")
    for _ in range(2):
        scored.write_stream(found, f"{target}/rows", f"{target}/checkpoint").awaitTermination()
    out = spark.read.parquet(f"{target}/rows").where("source_idx >= 0")
    return out.select("source_idx", "status", F.coalesce(F.size("thoughts_list"), F.lit(-1)).cast("long").alias("n_segments"))


_HITS = " + ".join(f"len(string_split({{0}}, '{t}')) - 1" for t in protected.PROTECTED)


@query(f"""with recursive {_LONG_FIXED}, seen as (select *, lead(segment) over (partition by source_idx order by k) as next from segs)
    select source_idx, count(*) as n_segments, cast(sum(length(segment)) as bigint) as n_chars, count(*) filter (not {_valid("segment")}) as n_invalid,
        count(*) filter (regexp_matches(segment, '{_ALNUM}[_-]*$') and regexp_matches(next, '^[_-]*{_ALNUM}') and not (regexp_matches(segment, '{text.CJK}$') and regexp_matches(next, '^{text.CJK}'))) as n_in_word,
        cast(sum({_HITS.format("segment")}) as bigint) as n_protected, cast(any_value({_HITS.format("gt_output")}) - sum({_HITS.format("segment")}) as bigint) as n_protected_lost
    from seen join longs using (source_idx) group by source_idx""")  # fmt: skip
def segment_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.segment_quality(convert.convert(long_samples(spark, sf_dir), LONG))


@query(f"""with recursive {_THRESHOLD_SEGMENTS}, joined as (select source_idx, string_agg(segment, '|~|' order by k) as thoughts_list, count(*) as n_segments from segs group by source_idx)
    select conv_id, system_prompt, question, gt_output, coalesce(thoughts_list, '') as thoughts_list, coalesce(n_segments, 0) as n_segments from usable left join joined using (source_idx)""")  # fmt: skip
def full_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From raw turns to training records: confidences, tau over all tokens, segments, in order of position."""
    tokens = stage(token_scores(spark, sf_dir))
    records = convert.full_run(samples(spark, sf_dir), _SHORT, ngram.confidence_arrays(tokens, "source_idx"), tokens, QUANTILES, TAU_KEY)
    return records.select("conv_id", "system_prompt", "question", "gt_output", F.array_join("thoughts_list", "|~|").alias("thoughts_list"), F.size("thoughts_list").cast("long").alias("n_segments"))


# Counters and audits.

_DONE = "usable and not overlong"
_SUMS = f"""count(*) as rows_seen, count(*) filter ({_DONE}) as rows_scored, count(*) filter ({_DONE}) as rows_written, count(*) filter (not ({_DONE})) as rows_skipped,
    count(*) filter (overlong) as num_overlong, cast(coalesce(sum(n_tokens) filter ({_DONE}), 0) as bigint) as token_count,
    cast(coalesce(sum(n_windows) filter ({_DONE}), 0) as bigint) as window_count, cast(coalesce(sum(n_tokens) filter ({_DONE}), 0) as bigint) as scored_token_count"""


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl.with_rank(convert.flagged(samples(spark, sf_dir), SMALL.with_(long_policy="skip")), RANKS)


@query(f"with {_SAMPLES}, {_COUNTED} select {_SUMS} from counted")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert.run_counters(_flags(spark, sf_dir))


@query(f"with {_SAMPLES}, {_COUNTED} select {_SUMS} from counted")
def summary_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters as the JSON file beside the data, read again."""
    counters, path = run_counters(spark, sf_dir), work_dir(spark)
    jsonl.write_summary(counters, path)
    return jsonl.read_summary(spark, path, counters.schema)


_BY_RANK = f"by_rank as (select source_idx % {RANKS} as rank, {_SUMS} from counted group by 1)"


@query(f"with {_SAMPLES}, {_COUNTED}, {_BY_RANK} select * from by_rank")
def run_counters_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert.run_counters(_flags(spark, sf_dir), "rank")


_PARTIALS = f"partials as (select *, case when rank > 0 then cast(token_count % 97 as double) end as memory_mb, cast(rows_seen as double) / 4 as seconds, {SMALL.max_length} + case when rank = {RANKS - 1} then 1 else 0 end as max_length, 'window' as long_policy, nullif(rank * 0, 0) as stride from by_rank)"


def _partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = run_counters_by_rank(spark, sf_dir)
    return rows.select(
        "*", F.when(F.col("rank") > 0, (F.col("token_count") % 97).cast("double")).alias("memory_mb"), (F.col("rows_seen") / 4).alias("seconds"),
        (F.lit(SMALL.max_length) + F.when(F.col("rank") == RANKS - 1, 1).otherwise(0)).alias("max_length"), F.lit("window").alias("long_policy"), F.nullif(F.col("rank") * 0, F.lit(0)).alias("stride"),
    )


@query(f"""with {_SAMPLES}, {_COUNTED}, {_BY_RANK}, {_PARTIALS} select {", ".join(f"cast(sum({c}) as bigint) as {c}" for c in convert.SUMS)}, max(memory_mb) as memory_mb, sum(seconds) as seconds,
    (select count(distinct source_idx) from usable) as sample_count, coalesce(sum(seconds) / nullif(sum(rows_scored), 0), 0.0) as seconds_per_row,
    coalesce(sum(seconds) / nullif(sum(scored_token_count), 0), 0.0) as seconds_per_token from partials""")  # fmt: skip
def merge_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert.merge_partials(_partials(spark, sf_dir), usable(spark, sf_dir).select("source_idx"))


@query(f"with {_SAMPLES}, {_COUNTED}, {_BY_RANK}, {_PARTIALS} select 'max_length' as setting, count(distinct max_length) as n_values from partials having count(distinct max_length) > 1")
def config_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert.config_mismatches(_partials(spark, sf_dir), ["max_length", "long_policy", "stride"])


@query(f"""with {_SAMPLES}, {_COUNTED}, {_BY_RANK}, written as (select source_idx % {RANKS} as rank, count(*) as output_rows from counted where {_DONE} and source_idx % 20 <> 5 group by 1)
    select rank, rows_seen, rows_scored, rows_written, coalesce(output_rows, 0) as output_rows, rows_written = coalesce(output_rows, 0) as consistent from by_rank left join written using (rank)""")  # fmt: skip
def output_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = stage(_flags(spark, sf_dir).select("source_idx", "rank", "usable", "dropped", "overlong", "n_tokens", "n_windows"))
    written = flags.where("usable and not dropped and source_idx % 20 <> 5")  # a run that has lost rows
    return convert.output_audit(convert.run_counters(flags, "rank"), written)
