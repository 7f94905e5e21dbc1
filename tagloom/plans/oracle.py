"""DuckDB SQL for the queries of the registry, on the same tables.

Written from the semantics, not from the Spark plans: rankings score all
pairs, walks are windows over everything that was scored.
"""

from __future__ import annotations

from tagloom import fixed
from tagloom.functions.prompts import generation_fixed_tokens, rating_fixed_tokens
from tagloom.plans import registry as r

TOKEN = r"[A-Za-z0-9]+|[^A-Za-z0-9\x09-\x0d\x20]"
WS = "||".join(f"chr({ord(c)})" for c in fixed.WHITE_SPACE)


def q(text: str) -> str:
    """A text as an SQL literal, line feeds spelled out."""
    lines = [f"'{part.replace(chr(39), chr(39) * 2)}'" for part in text.split("\n")]
    return "(" + " || chr(10) || ".join(lines) + ")"


def fill(template: str, **parts: str) -> str:
    sql = q(template)
    for name, column in parts.items():
        sql = sql.replace("{" + name + "}", f"' || {column} || '")
    return sql


def tokens(x: str) -> str:
    return f"len(regexp_extract_all({x}, '{TOKEN}'))"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def truncate(x: str, max_tokens: int) -> str:
    limit = max_tokens * fixed.CHARS_PER_TOKEN
    cut = f"substr({x}, 1, {limit})"
    back = f"position(' ' in reverse({cut}))"
    return (
        f"case when length({x}) <= {limit} then {x} "
        f"when {back} > 0 and {limit} - {back} > {limit * fixed.KEEP_FRACTION} "
        f"then substr({cut}, 1, {limit} - {back}) else {cut} end"
    )


def hashed(name: str, source: str, id: str, text: str) -> str:
    """CTEs: `name`(id, emb, fp) with the hashing embedder's vector of every source row."""
    return f"""
{name}_tok as (select {id} as id, unnest(regexp_extract_all({text}, '{TOKEN}')) as t from {source}),
{name}_cnt as (select id, ('0x' || substr(md5(t), 1, 8))::bigint % 64 as b, count(*) as c
  from {name}_tok group by all),
{name}_len as (select id, sqrt(sum(c * c)::double) as n from {name}_cnt group by id),
{name}_val as (select s.{id} as id, p.b, coalesce(floor(c / n * 4096.0 + 0.5), 0)::bigint as v
  from {source} s cross join (select unnest(range(64)) as b) p
  left join {name}_cnt c on c.id = s.{id} and c.b = p.b left join {name}_len l on l.id = s.{id}),
{name} as (select id, list(v / 4096.0::double order by b) as emb,
  string_agg(v::varchar, ',' order by b) as fp from {name}_val group by id)"""


def score(reply: str) -> str:
    return (
        f"coalesce(try_cast(nullif(regexp_extract({reply}, '{fixed.SCORE_PATTERN}', 1), '') as int), "
        f"list_min(list_transform(regexp_extract_all({reply}, '{fixed.NUMBER_PATTERN}', 1), "
        f"lambda n: n::int)))"
    )


def normalise(reply: str) -> str:
    return f"replace({strip(reply)}, chr(10), ' ')"


KIND = "flash card"
RATE_USER = fill(
    fixed.RATE_USER.replace("{kind}", KIND).replace("{Kind}", KIND.capitalize()),
    objective="objective", card="card",
)
LOCAL = fixed.EMBED_MAX_TOKENS_LOCAL
K = fixed.MAX_TOKENS_PER_OBJECTIVE // rating_fixed_tokens() + 1

# Notes within the limit, with vectors.
NOTES = f"""
note as (select doc_id::varchar as guid, text as card, {tokens('text')} as tokens,
  {truncate('text', LOCAL)} as cut from documents where {tokens('text')} <= {LOCAL}),
{hashed('note_emb', 'note', 'guid', 'cut')}"""

# Objectives of the benchmark.
OBJECTIVES = f"""
objective as (select item_id as oid, 'lecture_' || substr(md5(text), 1, 1) as tag,
  text as objective, {tokens('text')} as objective_tokens from benchmark),
{hashed('objective_emb', 'objective', 'oid', 'objective')},
obj as (select min(oid) as oid, tag, objective, any_value(objective_tokens) as objective_tokens, emb,
  count(*) as copies
  from objective join objective_emb on id = oid group by tag, objective, emb)"""

# Walk candidates; expects `obj`.
PAIRS = f"""
sims as (select oid, guid, objective_tokens, tokens, list_dot_product(obj.emb, e.emb) as cosine_sim
  from obj cross join note join note_emb e on e.id = guid),
ranked as (select *, row_number() over (partition by oid order by cosine_sim desc, guid) as rank from sims),
priced as (select *, {rating_fixed_tokens(KIND)} + objective_tokens + tokens as prompt_tokens
  from ranked where rank <= {K}),
spent as (select *, coalesce(sum(prompt_tokens) over (partition by oid order by rank
  rows between unbounded preceding and 1 preceding), 0)::bigint as used_before from priced),
within as (select s.*, tag, objective, card, copies from spent s join obj using (oid) join note using (guid)
  where used_before <= {fixed.MAX_TOKENS_PER_OBJECTIVE}),
pair as (select *, {RATE_USER} as ask from within)"""

# Replies of the hash judge; attempts count the rungs of its ladder.
JUDGED = f"""
dig as (select *, md5(ask) as d from pair),
num as (select *, ('0x' || substr(d, 1, 4))::int as good, ('0x' || substr(d, 5, 4))::int as val,
  ('0x' || substr(d, 9, 4))::int % 200 as mute, ('0x' || substr(d, 13, 4))::int % 4 as shape from dig),
said as (select *, case when good % 5 = 0 then 51 + val % 50 else val % 51 end as n from num),
told as (select *, case shape when 0 then 'Score: ' || n when 1 then ' ' || n || '/100 '
  when 2 then n::varchar else 'The card was read.' || chr(10) || 'Score: ' || n || ' of 100' end as spoken
  from said),
replied as (select *, case when mute < 10 then 'I cannot say.' else spoken end as first_reply,
  case when mute = 0 then 'I cannot say.' else spoken end as last_reply,
  case when mute = 0 then 5 when mute < 10 then 2 else 1 end as attempts from told),
judged as (select *, {normalise('last_reply')} as gpt_reply,
  {score(normalise('last_reply'))} as score from replied)"""


def walked(max_poor: int) -> str:
    return f"""
runs as (select *, rank - coalesce(max(case when score > {fixed.GOOD_SCORE} then rank end) over (
  partition by oid order by rank rows between unbounded preceding and current row), 0) as poor_run
  from judged),
worst as (select *, coalesce(max(poor_run) over (partition by oid order by rank
  rows between unbounded preceding and 1 preceding), 0) as worst_before from runs),
rated as (select * from worst where worst_before <= {max_poor})"""


def with_(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


RATED = with_(NOTES, OBJECTIVES, PAIRS, JUDGED, walked(fixed.MAX_POOR_MATCH_RUN))
RATED_SHORT = with_(NOTES, OBJECTIVES, PAIRS, JUDGED, walked(r.POOR_RUN))

SUFFIX = (
    f"case when coalesce(score, 0) >= {fixed.HIGH_CUTOFF} then '{fixed.HIGH_SUFFIX}' "
    f"when coalesce(score, 0) >= {fixed.MEDIUM_CUTOFF} then '{fixed.MEDIUM_SUFFIX}' "
    f"when coalesce(score, 0) >= {fixed.MINIMAL_CUTOFF} then '{fixed.MINIMAL_SUFFIX}' end"
)


def best(per: str) -> str:
    return f"""best as (select * from (select *, row_number() over (partition by {per}
  order by coalesce(score, 0) desc, tag, objective, rank) as nth from rated) where nth = 1)"""


TAGGED = f"""{best('guid')},
tagged as (select doc_id as id, doc_id::varchar as guid, case when suffix is null
  then ' ' || source || ' ' else ' ' || source || '  ' || tag || suffix || ' ' end as tags,
  (suffix is not null)::int as tagged
  from documents left join (select guid, tag, {SUFFIX} as suffix from best) on guid = doc_id::varchar)"""

LINES = """
raw as (select doc_id, unnest(string_split(text, chr(10))) as l,
  generate_subscripts(string_split(text, chr(10)), 1) - 1 as i from documents),
dressed as (select doc_id, i, case i % 6 when 0 then '1. - ' || l when 1 then '- 2. ' || l
  when 2 then '12.' || l when 3 then 'Learning Objective: ' || l
  when 4 then ' ' || chr(9) || '-- ' || l || ' ' || chr(10) || ' ' || chr(10) else l end as l from raw),
reply as (select doc_id, string_agg(l, chr(10) order by i) as reply from dressed group by doc_id),
piece as (select doc_id, unnest(string_split(reply, chr(10))) as l,
  generate_subscripts(string_split(reply, chr(10)), 1) - 1 as line_no from reply),
line as (select doc_id, line_no, STRIP as line from piece where length(STRIP) > 0)""".replace(
    "STRIP", strip("l")
)


def cleaned(line: str) -> str:
    return f"ltrim({strip(f'''regexp_replace({line}, '{fixed.LIST_NUMBER_PATTERN}', '')''')}, '- ')"


def headings(text: str) -> str:
    return " + ".join(f"contains({text}, '{w}')::int" for w in fixed.HEADING_WORDS)


CLEAN = f"clean as (select *, {cleaned('line')} as learning_objective from line)"
KEPT = f"kept as (select * from clean where {headings('learning_objective')} < {fixed.HEADING_WORD_LIMIT})"

GENERATE = (
    f"select doc_id, {q(fixed.GENERATE_SYSTEM)} || ' ' || {fill(fixed.GENERATE_USER, text='text')} as prompt "
    "from documents"
)
GENERATE_TOKENS = f"select doc_id, prompt, {tokens('prompt')} as prompt_tokens from ({GENERATE})"
LEFT = f"{r.SMALL_LIMIT} - prompt_tokens - {r.SMALL_BUFFER}"

# Objectives made from the conversations by the echo generator.
DOCUMENT = "doc as (select 'lecture_' || conv_id as name, string_agg(text, ' ' order by turn) as text from conversations group by conv_id)"
MADE = f"""{DOCUMENT},
piece as (select name, unnest(string_split(text, chr(10))) as l,
  generate_subscripts(string_split(text, chr(10)), 1) as i from doc),
line as (select name, {strip("i || '. ' || l")} as line, i from piece),
clean as (select *, name || '/' || i as lid, {cleaned('line')} as learning_objective from line),
kept as (select *, {truncate('line', LOCAL)} as cut, {tokens('line')} as tokens from clean
  where {headings('learning_objective')} < {fixed.HEADING_WORD_LIMIT}),
{hashed('kept_emb', 'kept', 'lid', 'cut')}"""
MADE_OBJECTIVES = f"""
obj as (select min(lid) as oid, name as tag, learning_objective as objective,
  any_value({tokens('learning_objective')}) as objective_tokens, emb, count(*) as copies
  from kept join kept_emb on id = lid group by name, learning_objective, emb)"""

LEADER = """
leader as (select label as obj_id, embedding::double[] as lead from
  (select *, row_number() over (partition by label order by vec_id) as n from embeddings) where n = 1)"""
DOT = "list_dot_product(embedding::double[], lead)"
COSINE = "list_cosine_similarity(embedding::double[], lead)"


ASKED = "asked as (select vec_id as obj_id, embedding::double[] as lead from embeddings)"


def topk(sim: str) -> str:
    return f"""{with_(ASKED)}
select obj_id, vec_id, label, cosine_sim, rank from (
  select *, row_number() over (partition by obj_id order by cosine_sim desc, vec_id) as rank from (
    select obj_id, vec_id, label, round({sim}, 6) as cosine_sim from embeddings cross join asked))
where rank <= {r.TOP_K}"""


QUANTITY = "l_quantity::int::varchar"
REPLY = f"""case l_linenumber
  when 1 then 'Score: ' || {QUANTITY}
  when 2 then 'Score: ' || l_partkey || '1234'
  when 3 then {QUANTITY} || '/100'
  when 4 then '  about' || chr(10) || {QUANTITY} || '.5 or ' || l_partkey || ' ' || chr(10)
  when 5 then '**Score:** ' || {QUANTITY}
  when 6 then 'x' || {QUANTITY} || 'y n/a'
  when 7 then 'Score:' || {QUANTITY} || chr(10) || 'Score: ' || l_partkey end"""

# Rated once, given out for every row of the objectives table.
EACH = "(select *, unnest(range(copies)) as copy from rated)"
SELECTED = f"select tag, objective, guid, card, cosine_sim, gpt_reply, score, rank from {EACH}"

OVERFLOW_CUT = (
    f"case when length({truncate('text', LOCAL)}) > {r.OVERFLOW_CHARS} "
    f"then {truncate('text', fixed.EMBED_FLOOR_TOKENS)} else {truncate('text', LOCAL)} end"
)

ORACLE = {
    "scan_notes": "select doc_id::varchar as guid, text as card from documents where length(text) > 0",
    "scan_notes_inline": "select doc_id::varchar as guid, text as card from documents where length(text) > 0",
    "scan_objectives": with_(OBJECTIVES)
    + "select tag as name, objective as learning_objective, objective_tokens as tokens, fp as emb "
    "from objective join objective_emb on id = oid",
    "scan_ratings_csv": RATED
    + f"select tag, objective, guid, card, gpt_reply, coalesce(score, 0) as score from {EACH}",
    "scan_vectors": """select vec_id::varchar as guid, 'label ' || label as card, label as tokens,
  generate_subscripts(embedding, 1) - 1 as pos, unnest(embedding)::double as value from embeddings""",
    "fill_scores": RATED + f"select tag, objective, guid, coalesce(score, 0) as score from {EACH}",
    "scan_documents": "select source as name, unnest(string_split(text, chr(10))) as text from documents",
    "scan_pages": """select 'lecture_' || conv_id as name,
  row_number() over (partition by conv_id order by turn) - 1 as page_no, text from conversations""",
    "path_stem": f"select page_id, regexp_extract(url, '{fixed.STEM_PATTERN}', 1) as stem from pages",
    "assemble_text": with_(DOCUMENT)
    + f"select name, text from doc where {tokens('text')} + {generation_fixed_tokens()} "
    f"<= {fixed.CHAT_MAX_TOKENS} - 2 * {fixed.CHAT_TOKEN_BUFFER}",
    "write_once": "select doc_id::varchar as guid, text as card from documents",
    "append_new": "select doc_id, source, lang, text from documents",
    "resume_anti": """select doc_id, source from documents d
where not exists (select 1 from labels l where l.doc_id = d.doc_id)""",
    "incremental_stream": RATED + f"select tag, objective, guid, rank, gpt_reply, score from {EACH}",
    "once_only_stream": RATED + "select tag, objective, guid, rank, gpt_reply, score from rated",
    "largest_source": """select source, count(*) as notes from documents
group by source order by notes desc, source limit 1""",
    "token_count": f"select doc_id, {tokens('text')} as tokens from documents",
    "token_filter": f"""select doc_id::varchar as guid, {tokens('text')} as tokens, text as card
from documents where {tokens('text')} <= {LOCAL}""",
    "truncate_text": f"select doc_id, {truncate('text', r.TRUNCATE_TOKENS)} as text from documents",
    "split_lines": with_(LINES) + "select doc_id, line_no, line from line",
    "clean_objective": with_(LINES, CLEAN) + "select doc_id, line_no, learning_objective from clean",
    "objective_filter": with_(LINES, CLEAN, KEPT)
    + "select doc_id, line_no, learning_objective from kept",
    "objective_counts": with_(LINES, CLEAN, KEPT)
    + "select doc_id as name, count(*) as objectives from kept group by doc_id",
    "rating_prompt": with_(NOTES, OBJECTIVES, PAIRS)
    + f"""select tag, objective, guid, {q(fixed.RATE_SYSTEM)} || ' ' || ask as prompt,
{tokens(q(fixed.RATE_SYSTEM) + " || ' ' || ask")} as prompt_tokens from pair""",
    "generation_prompt": GENERATE_TOKENS,
    "budget_strict": f"""select doc_id, {LEFT} as remaining,
({LEFT} >= {r.SMALL_BUFFER})::int as fits from ({GENERATE_TOKENS})""",
    "budget_clamped": f"""select doc_id, greatest({LEFT}, {r.SMALL_BUFFER}) as remaining
from ({GENERATE_TOKENS})""",
    "parse_score": f"""select l_orderkey, l_linenumber, l_partkey, l_quantity,
{score('reply')} as score from (select *, {normalise(REPLY)} as reply from lineitem)""",
    "dim_check": with_(ASKED)
    + """select 'notes' as side, any_value(len(embedding)) as first_dim, min(len(embedding)) as min_dim,
max(len(embedding)) as max_dim, count(*) as vectors from embeddings where len(embedding) > 0
union all select 'objectives', any_value(len(lead)), min(len(lead)), max(len(lead)), count(*) from asked""",
    "dot_product": with_(LEADER)
    + f"select vec_id, label, round({DOT}, 6) as sim from embeddings join leader on obj_id = label",
    "cosine": with_(LEADER)
    + f"select vec_id, label, round({COSINE}, 6) as sim from embeddings join leader on obj_id = label",
    "sim_topk": topk(DOT),
    "sim_topk_blocked": topk(DOT),
    "sim_topk_cosine": topk(COSINE),
    "sim_rank": with_(NOTES, OBJECTIVES, PAIRS)
    + """select tag as name, objective as learning_objective, guid, tokens, cosine_sim, rank
from priced join obj using (oid)""",
    "token_budget": with_(NOTES, OBJECTIVES, PAIRS)
    + f"""select tag, objective, guid, rank, prompt_tokens, used_before from pair
where used_before <= {fixed.MAX_TOKENS_PER_OBJECTIVE // 2}""",
    "poor_run_stop": RATED_SHORT
    + "select tag, objective, guid, rank, score, poor_run, worst_before from rated",
    "select_pairs": RATED_SHORT + SELECTED,
    "select_pairs_fold": RATED_SHORT + SELECTED,
    "select_pairs_lazy": RATED_SHORT + SELECTED,
    "embed_texts": with_(hashed("emb", "documents", "doc_id", "text"))
    + "select text as card, fp as emb from documents join emb on id = doc_id",
    "embed_retry": with_(
        f"src as (select doc_id, {OVERFLOW_CUT} as cut from documents)",
        hashed("emb", "src", "doc_id", "cut"),
    )
    + "select id::varchar as guid, fp as emb, null::varchar as emb_error from emb",
    "embed_failures": with_(hashed("emb", "documents", "doc_id", "text"))
    + "select id::varchar as guid, fp as emb, null::varchar as emb_error from emb",
    "generate_failures": with_(MADE)
    + "select name, learning_objective, tokens, fp as emb from kept join kept_emb on id = lid",
    "rate_failures": with_(NOTES, OBJECTIVES, PAIRS, JUDGED)
    + "select tag, objective, guid, gpt_reply, attempts, null::varchar as rate_error, score from judged",
    "embed_notes_job": with_(NOTES)
    + "select guid, card, tokens, fp as emb from note join note_emb on id = guid",
    "make_objectives": with_(MADE)
    + "select name, learning_objective, tokens, fp as emb from kept join kept_emb on id = lid",
    "make_objectives_rejected": with_(DOCUMENT)
    + f"""select name, {tokens('text')} as text_tokens from doc
where {tokens('text')} + {generation_fixed_tokens()} > {r.SMALL_LIMIT} - 2 * {r.SMALL_BUFFER}""",
    "judge_pairs": with_(NOTES, OBJECTIVES, PAIRS, JUDGED)
    + "select tag, objective, guid, first_reply as reply from judged",
    "judge_ladder": with_(NOTES, OBJECTIVES, PAIRS, JUDGED)
    + "select tag, objective, guid, gpt_reply, attempts, score from judged",
    "best_per_note": RATED.rstrip()
    + """,
place as (select tag, objective, row_number() over (order by item_id % 2, item_id) - 1 as ordinal
  from (select item_id, 'lecture_' || substr(md5(text), 1, 1) as tag, text as objective from benchmark)),
best as (select *, row_number() over (partition by guid order by coalesce(score, 0) desc, ordinal, rank) as nth
  from rated join (select tag, objective, min(ordinal) as ordinal from place group by all) using (tag, objective))
select guid, tag, objective, coalesce(score, 0) as score, rank, ordinal from best where nth = 1""",
    "best_per_note_and_tag": RATED.rstrip() + "," + best("guid, tag")
    + " select guid, tag, objective, coalesce(score, 0) as score, rank from best",
    "relevance_bucket": RATED + f"select tag, objective, guid, score, {SUFFIX} as suffix from {EACH}",
    "guid_overlap": RATED
    + "select guid from rated intersect select doc_id::varchar from documents",
    "overlap_report": RATED
    + f"""select count(distinct guid) as rated_guids, any_value(c.n) as note_rows, any_value(g) as note_guids,
count(distinct guid) filter (where guid in (select doc_id::varchar from documents)) as matching_guids,
(any_value(c.n) < count(distinct guid) * {fixed.MISMATCH_FRACTION})::int as few_notes,
(count(distinct guid) filter (where guid in (select doc_id::varchar from documents)) = 0)::int as no_match
from rated, (select count(*) as n, count(distinct doc_id) as g from documents) c""",
    "tag_notes": RATED.rstrip() + "," + TAGGED + " select id, guid, tags, tagged from tagged",
    "tag_report": RATED.rstrip() + "," + TAGGED
    + " select count(*) as notes, sum(tagged)::bigint as tagged from tagged",
    "flagship": with_(
        NOTES, MADE, MADE_OBJECTIVES, PAIRS, JUDGED, walked(fixed.MAX_POOR_MATCH_RUN), TAGGED
    )
    + "select id, guid, tags, tagged from tagged",
}
ORACLE["flagship_files"] = ORACLE["flagship"]
