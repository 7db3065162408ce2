"""DuckDB SQL that states, independently of Spark, what each registered query
must return.  Only the raw driver tables are registered as views, so the
stand-in tables are inlined as CTEs.
"""

from __future__ import annotations

from qamill.functions.text import (INSTRUCT_HEAD, INSTRUCT_MID, INSTRUCT_TAIL, PY_WS_CODEPOINTS,
                                   SHORT_HEAD, SHORT_MID, WORD_REGEX)
from qamill.operators.clean import SAFE_TYPES
from qamill.operators.profile import DROP_KEYS, EXPECTED_TYPES
from qamill.plans import catalog as Q
from qamill.plans.standins import DOC_TYPES


def lit(s: str) -> str:
    """A SQL string literal; newlines become ``chr(10)`` so the text stays one line."""
    parts = s.split("\n")
    quoted = ["'" + p.replace("'", "''") + "'" for p in parts]
    return " || chr(10) || ".join(quoted)


def lst(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


WS = "||".join(f"chr({cp})" for cp in PY_WS_CODEPOINTS)
W = lit(WORD_REGEX)


def blank(c: str) -> str:
    return f"(trim({c}, {WS}) = '')"


def words(c: str) -> str:
    return f"regexp_extract_all({c}, {W})"


QA_DOCS = f"""qa_docs as (
  select doc_id as id, source as synonyms,
    case when doc_id % 23 = 0 then null
         else ({lst(DOC_TYPES)})[cast(doc_id % {len(DOC_TYPES)} as integer) + 1] end as question_type,
    case when doc_id % 13 = 0 then null when doc_id % 17 = 0 then '  ' || chr(9)
         else split_part(text, chr(10), 1) end as question,
    lang as question_focus,
    case when doc_id % 19 = 0 then null when instr(text, chr(10)) = 0 then ''
         else substr(text, instr(text, chr(10)) + 1) end as answer
  from documents)"""

QA_CLEAN = f"""qa_clean as (
  select id, synonyms, question_type, question, question_focus, answer from qa_docs
  where question is not null and answer is not null and not {blank('question')} and not {blank('answer')}
    and lower(question_type) in ({", ".join(lit(t) for t in SAFE_TYPES)}))"""

QA_PAIRS = """qa_pairs as (
  select cast(u.conv_id * 100 + u.turn as bigint) as id, u.text as question, a.text as answer
  from conversations u join conversations a on a.conv_id = u.conv_id and a.turn = u.turn + 1
  where u.role = 'user' and a.role = 'assistant')"""

SPLITS = f"""ranked as (
  select c.*, cast(row_number() over (order by md5('{Q.SEED}|' || cast(id as varchar)), id) - 1 as bigint) as pos,
         count(*) over () as n_total from qa_clean c),
bounds as (
  select *, cast(floor(n_total * cast(0.6 as double)) as bigint) as nt,
            cast(floor(n_total * cast(0.2 as double)) as bigint) as nv from ranked),
splits as (
  select *,
    case when pos < nt then 'training' when pos < nt + nv then 'validation' else 'evaluation' end as split,
    case when pos < nt then pos when pos < nt + nv then pos - nt else pos - nt - nv end as split_pos,
    case when pos < nt then nt when pos < nt + nv then nv else n_total - nt - nv end as split_size
  from bounds)"""

PROD = """prod as (
  select id, cast(case when floor(split_size / 3) = 0 then 3
                       else least(2, floor(split_pos / floor(split_size / 3))) + 1 end as integer) as batch
  from splits where split = 'evaluation')"""

PROFILE = f"""prof as (
  select cast(count(*) as bigint) as initial_records,
    cast(count_if(question is null) as bigint) as missing_question,
    cast(count_if(answer is null) as bigint) as missing_answer,
    cast(count_if(question is not null and {blank('question')}) as bigint) as blank_question,
    cast(count_if(answer is not null and {blank('answer')}) as bigint) as blank_answer,
    cast(count_if(question is null or answer is null or {blank('question')} or {blank('answer')}) as bigint)
      as rows_removed
  from qa_docs)"""

EV = """ev as (
  select *, cast(date_diff('day', (select min(cast(ts as date)) from events), cast(ts as date)) + 1 as integer)
    as version from events),
meta as (
  select 'v' || cast(version as varchar) as version_tag, version,
         strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%fZ') as timestamp,
         case when version % 5 = 0 then null else count(*) end as record_count
  from ev group by version having version % 7 <> 0)"""

LENS = f"""lens as (
  select split, cast(len({words('question')}) as integer) as x from splits)"""

PROMPT_SHORT = f"{lit(SHORT_HEAD)} || coalesce(question, 'None') || {lit(SHORT_MID)} || coalesce(answer, 'None')"
PROMPT_INSTRUCT = (f"{lit(INSTRUCT_HEAD)} || coalesce(question, 'None') || {lit(INSTRUCT_MID)} || "
                   f"coalesce(answer, 'None') || {lit(INSTRUCT_TAIL)}")

def vocab_sql(src: str = "p", where: str = "true") -> str:
    """CTEs ``wc`` and ``vocab`` over the prompts of CTE ``src``."""
    return f"""wc as (select word, count(*) as n from (select unnest({words('prompt')}) as word from {src}
                                             where {where}) group by word),
vocab as (
  select word, cast(n as bigint) as n,
         cast(row_number() over (order by n desc, word) + 1 as integer) as token_id
  from wc qualify row_number() over (order by n desc, word) <= {Q.VOCAB_SIZE})"""


def encode_sql(src: str = "p", extra: str = "") -> str:
    """CTE ``encoded``: fixed-length arrays for every prompt of CTE ``src``;
    ``extra`` = more columns of ``src`` to keep (with a leading comma)."""
    return f"""pw as (select id{extra}, ({words('prompt')})[1:{Q.SEQ_LEN}] as ws from {src}),
ex as (select id, unnest(ws) as word, unnest(range(len(ws))) as i from pw),
ids as (
  select ex.id, list(cast(coalesce(v.token_id, 0) as integer) order by ex.i) as ids
  from ex left join vocab v on v.word = ex.word group by ex.id),
enc as (
  select pw.*, coalesce(ids.ids, []) as ids from pw left join ids on ids.id = pw.id),
encoded as (
  select id{extra},
    list_concat(ids, list_transform(range({Q.SEQ_LEN} - len(ids)), lambda x: cast(1 as integer))) as input_ids,
    list_concat(list_transform(range(len(ids)), lambda x: cast(1 as integer)),
                list_transform(range({Q.SEQ_LEN} - len(ids)), lambda x: cast(0 as integer))) as attention_mask,
    list_concat(ids, list_transform(range({Q.SEQ_LEN} - len(ids)), lambda x: cast(1 as integer))) as labels
  from enc)"""


VOCAB = f"""p as (select id, {PROMPT_SHORT} as prompt from qa_pairs),
{vocab_sql()}"""

ENCODE = encode_sql()


def whole(sql: str) -> str:
    """The same without a cap on the vocabulary."""
    cap = f" qualify row_number() over (order by n desc, word) <= {Q.VOCAB_SIZE}"
    assert cap in sql
    return sql.replace(cap, "")


def box_sql(table: str, column: str, group: str, whisker: float) -> str:
    """CTE ``box``: the box summary of a column per group, by exact linear quantiles."""
    return f"""src as (select {group} as g, cast({column} as double) as x from {table}),
quartiles as (
  select g, count(*) as n, min(x) as min, max(x) as max, quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.5) as median,
         quantile_cont(x, 0.75) as q3 from src group by g),
box as (select *, q3 - q1 as iqr, q1 - {whisker} * (q3 - q1) as lower_fence, q3 + {whisker} * (q3 - q1) as upper_fence from quartiles)"""


def permuted_sql() -> str:
    """Batches of epochs 0 and 1 of the training split: a Feistel permutation on an a x b grid, walked on until below n."""
    from qamill.operators.order import round_keys  # noqa: PLC0415

    def rounds(src: str, epoch: int) -> str:
        sql = f"select id, n, a, b, x // b as r, x % b as c from {src}"
        for i, (m, k) in enumerate(round_keys(Q.SEED, epoch)):
            row = f"(r + ((c * {m} + {k}) % 2147483647) // 8) % a" if i % 2 == 0 else "r"
            col = "c" if i % 2 == 0 else f"(c + ((r * {m} + {k}) % 2147483647) // 8) % b"
            sql = f"select id, n, a, b, {row} as r, {col} as c from ({sql})"
        return f"select id, n, a, b, r * b + c as x from ({sql})"

    epochs = ",\n".join(f"""walk{e} as ({rounds("train", e)} union all {rounds(f"(select * from walk{e} where x >= n)", e)}),
at{e} as (select {e} as epoch, id, x from walk{e} where x < n)""" for e in (0, 1))
    return f"""with recursive {QA_DOCS}, {QA_CLEAN}, {SPLITS},
size as (select count(*) as n, cast(floor(sqrt(count(*))) as bigint) as s from splits where split = 'training'),
grid as (select n, a, (n + a - 1) // a as b from (select n, unnest(range(greatest((s + 1) // 2, s - 100000, 1), s + 1)) as a from size)
         order by ((n + a - 1) // a) * a - n, a desc limit 1),
train as (select id, n, a, b, split_pos as x from splits, grid where split = 'training'),
{epochs}
select cast(epoch as integer) as epoch, x // {Q.BATCH_SIZE} as batch_id, list(id order by x) as ids, cast(count(*) as integer) as n_rows
from (select * from at0 union all select * from at1) group by epoch, x // {Q.BATCH_SIZE}"""


TYPES_IN = ", ".join(lit(t) for t in Q.EXPLORE_TYPES)
KW = lit("(?i)" + Q.EXPLORE_KEYWORD)


def _box_sql() -> str:
    parts = []
    for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        parts.append(f"cast((n - 1) as double) * {q} as p_{name}")
    kth = []
    for name in ("q1", "median", "q3"):
        kth.append(f"cast(min(case when cum >= floor(p_{name}) + 1 then x end) as double) as lo_{name}")
        kth.append(f"cast(min(case when cum >= ceil(p_{name}) + 1 then x end) as double) as hi_{name}")
        kth.append(f"any_value(p_{name}) as p_{name}")
    qexpr = ",\n    ".join(
        f"lo_{name} + (hi_{name} - lo_{name}) * (p_{name} - floor(p_{name})) as {name}"
        for name in ("q1", "median", "q3"))
    return f"""with {QA_DOCS}, {QA_CLEAN}, {SPLITS}, {LENS},
hist as (select split, x, count(*) as c from lens group by split, x),
cum as (select split, x, c, sum(c) over (partition by split order by x) as cum,
               sum(c) over (partition by split) as n from hist),
pq as (select *, {", ".join(parts)} from cum),
agg as (
  select split, cast(any_value(n) as bigint) as n, cast(min(x) as double) as min, cast(max(x) as double) as max,
    {", ".join(kth)}
  from pq group by split),
qs as (select split, n, min, max,
    {qexpr} from agg),
f as (select *, q3 - q1 as iqr, q1 - 1.5 * (q3 - q1) as lower_fence, q3 + 1.5 * (q3 - q1) as upper_fence from qs),
wh as (
  select h.split,
    cast(min(case when x >= lower_fence and x <= upper_fence then x end) as double) as whisker_low,
    cast(max(case when x >= lower_fence and x <= upper_fence then x end) as double) as whisker_high,
    cast(coalesce(sum(case when not (x >= lower_fence and x <= upper_fence) then c end), 0) as bigint)
      as n_outliers
  from hist h join f on f.split = h.split group by h.split)
select f.split, n, min, q1, median, q3, max, iqr, lower_fence, upper_fence,
       whisker_low, whisker_high, n_outliers
from f join wh on wh.split = f.split"""


HIST_SQL = f"""with {QA_DOCS}, {QA_CLEAN}, {SPLITS}, {LENS},
rng as (select split, cast(min(x) as double) as lo, cast(max(x) as double) as hi from lens group by split),
b as (
  select l.split, r.lo,
    case when r.hi = r.lo then 0
         else least(29, cast(floor((cast(l.x as double) - r.lo) / ((r.hi - r.lo) / cast(30 as double))) as integer))
    end as bin,
    case when r.hi = r.lo then cast(0 as double) else (r.hi - r.lo) / cast(30 as double) end as w
  from lens l join rng r on r.split = l.split)
select split, cast(bin as integer) as bin, lo + bin * w as bin_low, lo + (bin + 1) * w as bin_high,
       cast(count(*) as bigint) as n
from b group by split, bin, lo, w"""


def oracle_sql() -> dict[str, str]:
    dropped = " union all ".join(f"select '{k}' as type, {k} as count from prof2" for k in DROP_KEYS)
    return {
        "quality_profile": f"""with {QA_DOCS}, {PROFILE}
select initial_records, missing_question, missing_answer, blank_question, blank_answer,
       cast(missing_question + missing_answer + blank_question + blank_answer as bigint) as total_dropped,
       rows_removed from prof""",
        "clean_allowlist": f"with {QA_DOCS}, {QA_CLEAN} select * from qa_clean",
        "split_60_20_20": f"with {QA_DOCS}, {QA_CLEAN}, {SPLITS} select id, pos, split, split_pos from splits",
        "split_counts": f"""with {QA_DOCS}, {QA_CLEAN},
c as (select count(*) as n from qa_clean),
s as (select n, cast(floor(n * cast(0.6 as double)) as bigint) as t,
             cast(floor(n * cast(0.2 as double)) as bigint) as v from c)
select 'training' as split, t as n from s
union all select 'validation', v from s
union all select 'evaluation', cast(n - t - v as bigint) from s""",
        "production_batches": f"with {QA_DOCS}, {QA_CLEAN}, {SPLITS}, {PROD} select id, batch from prod",
        "split_80_20_ordered": f"""with {QA_PAIRS},
r as (select id, cast(row_number() over (order by id) - 1 as bigint) as pos, count(*) over () as n from qa_pairs)
select id, pos, case when pos < floor(n * cast(0.8 as double)) then 'training' else 'validation' end as split
from r""",
        "type_distribution": f"""with {QA_DOCS}, {QA_CLEAN},
g as (select question_type, count(*) as n from qa_clean group by question_type)
select question_type, cast(n as bigint) as n, cast(n as double) / cast(sum(n) over () as double) as share from g""",
        "distinct_types": f"with {QA_DOCS} select distinct question_type from qa_docs",
        "missing_types": f"""with {QA_DOCS}, {QA_CLEAN}, {SPLITS}, {PROD},
pb as (select p.batch, c.question_type from prod p join qa_clean c on c.id = p.id),
g as (select distinct batch from pb),
e as (select unnest({lst(EXPECTED_TYPES)}) as missing_type)
select g.batch, e.missing_type from g, e
where not exists (select 1 from pb where pb.batch = g.batch and lower(pb.question_type) = e.missing_type)""",
        "question_words": f"""with {QA_DOCS}, {QA_CLEAN}
select id, cast(len({words('question')}) as integer) as question_length from qa_clean""",
        "length_box": _box_sql(),
        "length_histogram": HIST_SQL,
        "explore_filter": f"""with {QA_DOCS}, {QA_CLEAN}
select id, question_type, question from qa_clean
where question_type in ({TYPES_IN}) and regexp_matches(question, {KW})""",
        "explore_counts": f"""with {QA_DOCS}, {QA_CLEAN}
select cast(count_if(coalesce(question_type in ({TYPES_IN}), false)
                     and coalesce(regexp_matches(question, {KW}), false)) as bigint) as shown,
       cast(count(*) as bigint) as total from qa_clean""",
        "explore_sample": f"""with {QA_DOCS}, {QA_CLEAN}
select id, question_type, question from qa_clean
where question_type in ({TYPES_IN}) and regexp_matches(question, {KW})
order by md5('{Q.SEED}|' || cast(id as varchar)), id limit 10""",
        "dropped_rows": f"""with {QA_DOCS}, {PROFILE},
prof2 as (select *, cast(missing_question + missing_answer + blank_question + blank_answer as bigint)
                    as total_dropped from prof)
{dropped}""",
        "version_history": f"""with {EV},
h as (select version_tag as version, cast(coalesce(record_count, 0) as bigint) as records,
             cast(replace(timestamp, 'Z', '') as timestamp) as timestamp from meta)
select version, records, timestamp,
       cast(row_number() over (order by timestamp asc nulls last, version) as integer) as seq from h""",
        "latest_version": f"""with {EV}
select event_id, version, event_type, value from ev
where version = (select max(m.version) from meta m where m.version in (select version from ev))""",
        "schema_union": f"""select event_id as id, printf('%.2f', value) as answer,
       cast(json_extract_string(props, '$.k') as bigint) as k, event_type as question,
       case when event_id % 2 = 0 then event_type end as question_type,
       case when event_id % 4 = 1 then user_id end as user
from events where event_id % 11 <> 0 and not {blank('event_type')}""",
        "prompt_instruct": f"with {QA_PAIRS} select id, {PROMPT_INSTRUCT} as prompt from qa_pairs",
        "prompt_short": f"with {QA_PAIRS} select id, {PROMPT_SHORT} as prompt from qa_pairs",
        "vocabulary": f"with {QA_PAIRS}, {VOCAB} select word, n, token_id from vocab",
        "encode_fixed": f"with {QA_PAIRS}, {VOCAB}, {ENCODE} select * from encoded",
        "vocabulary_whole": f"with {QA_PAIRS}, {whole(VOCAB)} select word, n, token_id from vocab",
        "encode_whole": f"with {QA_PAIRS}, {whole(VOCAB)}, {ENCODE} select * from encoded",
        "next_token_pairs": f"""with {QA_PAIRS}, {VOCAB}, {ENCODE}
select id, input_ids[1:{Q.SEQ_LEN - 1}] as inputs, labels[2:{Q.SEQ_LEN}] as targets from encoded""",
        "batches_epoch": f"""with {QA_DOCS}, {QA_CLEAN}, {SPLITS},
tr as (select id, row_number() over (order by md5('{Q.SEED}|0|' || cast(id as varchar)), id) - 1 as bpos
       from splits where split = 'training'),
va as (select id, split_pos as bpos from splits where split = 'validation')
select 'training' as split, cast(0 as integer) as epoch, cast(bpos // {Q.BATCH_SIZE} as bigint) as batch_id,
       list(id order by bpos) as ids, cast(count(*) as integer) as n_rows from tr group by bpos // {Q.BATCH_SIZE}
union all
select 'validation', cast(0 as integer), cast(bpos // {Q.BATCH_SIZE} as bigint),
       list(id order by bpos), cast(count(*) as integer) from va group by bpos // {Q.BATCH_SIZE}""",
        "price_box": f"""with {box_sql("lineitem", "l_extendedprice", "l_returnflag", Q.PRICE_WHISKER)}
select b.g as l_returnflag, n, min, q1, median, q3, max, iqr, lower_fence, upper_fence,
       min(x) filter (x between lower_fence and upper_fence) as whisker_low,
       max(x) filter (x between lower_fence and upper_fence) as whisker_high,
       count(*) filter (not x between lower_fence and upper_fence) as n_outliers
from box b join src s on s.g = b.g group by all""",
        "box_outliers": f"""with {box_sql("lineitem", "l_extendedprice", "1", Q.PRICE_WHISKER)}
select l_orderkey, l_linenumber, l_extendedprice from lineitem, box
where l_extendedprice < lower_fence or l_extendedprice > upper_fence""",
        "event_outliers": f"""with {box_sql("events", "value", "event_type", 1.5)}
select event_id, event_type, value from events join box on g = event_type where value < lower_fence or value > upper_fence""",
        "worker_shards": f"""with {QA_DOCS}, {QA_CLEAN}, {SPLITS}
select id, split, cast(split_pos % {Q.WORKERS} as integer) as shard from splits""",
    }
