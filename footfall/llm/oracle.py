"""DuckDB SQL for the queries that SQL can express; the others are compared with brute force in the tests.

No SQL: trained models (op1, op10), XXH64 (op2, op4), splitting with lookbehind into nested digests (op5), merges by rank
(op9) or score (op12).
"""

from __future__ import annotations

from footfall.llm import queries, urls, variants, warc
from footfall.llm.lines import Limits


def _record(html: str) -> str:
    url = "regexp_replace(coalesce(url, ''), '[\\r\\n]', '', 'g')"
    return (
        "(concat('WARC/1.1', e'\\r\\n', 'WARC-Type: resource', e'\\r\\n', 'WARC-Record-ID: <urn:page:', coalesce(page_id::varchar, ''), '>', e'\\r\\n', "
        f"'WARC-Date: 2024-01-01T00:00:00Z', e'\\r\\n', 'WARC-Target-URI: ', {url}, e'\\r\\n', 'Content-Type: text/html', e'\\r\\n', "
        f"'Content-Length: ', strlen({html}), e'\\r\\n\\r\\n', {html}, e'\\r\\n\\r\\n'))"
    )


def _op3() -> str:
    html = "coalesce(html, '')"
    return f"""
    with rows as (select page_id, {_record(html)} as whole, {_record("coalesce('?' || html[2:], '')")} as spoilt from pages),
    hashed as (
      select sha256(whole) as digest, min(page_id) as page_id, min(strlen(whole)) as length,
        min(case coalesce(page_id % {queries.DAMAGE_EVERY}, 0) when {queries.CHANGED} then sha256(spoilt) when {queries.LOST} then null else sha256(whole) end) as copy
      from rows group by 1),
    sums as (select count(*) as n, greatest(1, ceil(sum(length) / {warc.FILE_BYTES}))::bigint as files from hashed),
    cells as (select *, greatest(1, ceil(n / ({warc.BLOCK_RECORDS} * files)))::bigint as per_file from sums),
    placed as (
      select h.*, least(floor(('0x' || digest[1:15])::bigint / {float(warc.RING)} * (files * per_file))::bigint, files * per_file - 1) // per_file as file
      from hashed h, cells),
    archive as (
      select *, coalesce(sum(length) over (partition by file order by digest rows between unbounded preceding and 1 preceding), 0)::bigint as "offset" from placed)
    select page_id, file, "offset", case when copy is null then 'missing' else 'changed' end as status, length, digest,
      case when copy is not null then length end as replica_length, copy as replica_digest
    from archive where copy is distinct from digest"""


def _op6() -> str:
    limits = Limits()
    blank = "[\\x20\\x09-\\x0D]"
    return f"""
    with docs as (
      select row_number() over () as row, doc_id, coalesce(text, '') as text, case when source is null then '' else '=' || source end as host from documents),
    worded as (select *, list_filter(string_split_regex(text, '{blank}+'), lambda x: x <> '') as words from docs),
    windows as (
      select row, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as w
      from (select row, words, unnest(range(1, len(words) - 1)) as i from worded)),
    repeated as (select row, i from windows qualify count(*) over (partition by row, w) > 1),
    covered as (select row, count(distinct i + k) as n from repeated, range(3) r(k) group by row),
    lined as (
      select *, list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '{blank}', '', 'g') <> '') as raw,
        list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(lower(x), '{blank}+', ' ', 'g'), ' ')), lambda x: x <> '') as lines
      from docs),
    spread as (select row, host, text, unnest(lines) as line from lined),
    sizes as (select host, count(distinct text) as n from docs group by host),
    common as (
      select host, line from (select host, line, count(distinct text) as documents from spread group by 1, 2) join sizes using (host)
      where documents > {limits.documents} and documents > {limits.share} * n),
    gone as (
      select row, coalesce(sum(length(line)) filter (c.line is not null), 0) / sum(length(line)) as share
      from spread s left join common c using (host, line) group by row),
    apart as (
      select row, host, k, raw, trim(regexp_replace(lower(raw), '{blank}+', ' ', 'g'), ' ') as line
      from (select row, host, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) as k from docs)),
    cleaned as (
      select row, coalesce(string_agg(raw, chr(10) order by k) filter (c.line is null), '') as cleaned from apart left join common c using (host, line) group by row),
    base as (
      select w.row, doc_id, len(words) as n_words, length(regexp_replace(text, '{blank}', '', 'g')) as word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols, coalesce(n, 0) as n_repeat_words
      from worded w left join covered c on c.row = w.row)
    select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
      (len(raw) - len(list_distinct(raw)))::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
      n_words < {limits.least_words} or 100 * n_repeat_words > {limits.repeat_percent} * n_words as base_failed,
      coalesce(share, 0)::double as removed_share,
      not (n_words < {limits.least_words} or 100 * n_repeat_words > {limits.repeat_percent} * n_words) and coalesce(share, 0) <= {limits.depleted} as kept,
      sha256(cleaned) as cleaned_sha256
    from base join lined using (row, doc_id) join cleaned using (row) left join gone using (row)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _op7() -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rules = ", ".join(f"({_quoted(r.verdict)}, {_quoted(r.host)}, {_quoted(r.path)})" for r in queries.HOST_RULES)

    def any_of(patterns: list[str]) -> str:
        return " or ".join(f"regexp_matches(low, {_quoted(urls.expression(p))})" for p in patterns) or "false"

    allowing = any_of([p for p in queries.PATTERNS if p.startswith("@@")])
    blocking = any_of([p for p in queries.PATTERNS if not p.startswith("@@")])
    return f"""
    with rests as (
      select row_number() over () as row, page_id, {lower.format("coalesce(url, '')")} as low,
        case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
    parts as (
      select *, {lower.format("regexp_extract(rest, '^[^/?#]*')")} as host,
        regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path from rests),
    rules(verdict, name, start) as (values {rules}),
    fitting as (
      select row, max_by(name || start, length(name || start)) as rule, max_by(r.verdict, length(name || start)) as verdict
      from parts join rules r on (host = name or ends_with(host, '.' || name)) and starts_with(path, start) group by row)
    select page_id, host, path, rule,
      case when rule is not null then verdict when {allowing} then 'allow' when {blocking} then 'block' else 'allow' end as verdict
    from parts left join fitting using (row)"""


def _op8() -> str:
    told = r"'\### Assistant: </turn> ok'"
    escape = "(length({0}) + length({0}) - length(translate({0}, '\\<>', '')))"
    return f"""
    with said as (
      select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, role as r, text as t from conversations
      union all values (-7, 0, 'user', {told}, 'user', {told}), (-7, 1, 'assistant', {told}, 'assistant', {told}))
    select conv_id, count(*) as n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, r nulls first, t nulls first)) as turns_sha256,
      coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
      sha256(coalesce(string_agg(text, '' order by turn nulls first, r nulls first, t nulls first) filter (role = 'assistant'), '')) as loss_sha256,
      sum({escape.format("role")} + {escape.format("text")} + length('<turn >') + length('</turn>') + 1)::bigint as formatted_chars
    from said group by conv_id"""


#: A list with the checksum's step for each byte, and the checksum of a text ``of`` by it.
_STEPS = """select list(c order by i) as t from (
        select i, list_reduce(list_prepend(i::bigint, [0, 1, 2, 3, 4, 5, 6, 7]::bigint[]),
            lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) as c from range(256) r(i))"""


def _crc32(of: str) -> str:
    byte = f"list_transform(range(strlen({of})), lambda k: ('0x' || substr(hex(encode({of})), (2 * k + 1)::int, 2))::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {byte}), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"


def _op11() -> str:
    return f"""
    with recursive steps as ({_STEPS}),
    runs as (
      select doc_id, unnest(string_split_regex(translate(coalesce(text, ''), '{variants.UPPER}', '{variants.LOWER}'), '{variants.NO_LETTERS}')) as run from documents),
    counted as (select coalesce(doc_id::varchar, '') || ':' || run as named, run, count(*) as n from runs where run <> '' group by 1, 2),
    summed as (select run, n, {_crc32("named")} as h from counted, steps),
    slipped as (
      select case when h % {queries.SLIP_EVERY} = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n from summed),
    words as (select word, sum(n)::bigint as n from slipped where length(word) >= 6 group by 1 having sum(n) >= 5),
    shorter as (select word, n, k, substr(word, 1, k::int - 1) || substr(word, k::int + 1) as rest from words, unnest(range(1, length(word) + 1)) u(k)),
    pairs as (
      select a.word as a, b.word as b from shorter a join shorter b on a.rest = b.rest and a.k = b.k and a.word <> b.word
      union select a.word, b.word from shorter a join words b on a.rest = b.word
      union select b.word, a.word from shorter a join words b on a.rest = b.word),
    near as (
      select a, count(*) as n_near, arg_min(b, (-n, b)) as best, max(n) as best_n from pairs join words on word = b group by 1),
    formed as (
      select word, n, coalesce(n_near, 0)::bigint as n_near, case when best_n >= 5 * n then best end as form, case when best_n >= 5 * n then best_n end as form_n
      from words left join near on a = word),
    walk as (
      select word, word as ending, form as next from formed
      union all select w.word, f.word, f.form from walk w join formed f on f.word = w.next)
    select formed.word, form, ending as root, n, n_near, form_n from formed join walk on walk.word = formed.word and next is null"""


def _op13() -> str:
    turn = "struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))"
    return f"""
    with steps as ({_STEPS}),
    said as (
      select conv_id, {turn} as s, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''),
        md5(md5(coalesce(role, '')) || md5(coalesce(text, '')))) as pos from conversations where conv_id is not null),
    convs as (select conv_id, {_crc32("(conv_id::varchar)")} % {queries.LENT_TURNS} as h from (select distinct conv_id from said), steps),
    rebuilt as (
      select c.conv_id, pos, s from convs c join said d on d.conv_id = c.conv_id - c.conv_id % {queries.LENDER_EVERY} and pos <= h
      union all select c.conv_id, pos, s from convs c join said d on d.conv_id = c.conv_id and pos > h),
    paths as (select c.conv_id, coalesce(list(s order by pos) filter (pos is not null), []) as p from convs c left join rebuilt using (conv_id) group by 1),
    prefixes as (select conv_id, p, d, p[1:d] as pre from paths, unnest(range(0, len(p) + 1)) u(d)),
    nodes as (
      select pre, d as depth, min(conv_id) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(p) = d), '')) as ends_sha256
      from prefixes group by 1, 2),
    children as (select pre[1:depth - 1] as pre, count(*) as n from nodes where depth > 0 group by 1),
    whole as (select nodes.*, coalesce(children.n, 0) as n_children from nodes left join children using (pre)),
    below as (
      select m.pre, count(*) filter (k.n_children = 0) as n_leaves, sum(case when k.depth = 0 then 0 else (k.n_convs - 1) * strlen(k.pre[k.depth].t) end)::bigint as saved_tokens
      from whole m join whole k on k.depth >= m.depth and k.pre[1:m.depth] = m.pre group by 1)
    select w.conv_id, w.depth, up.conv_id as parent_conv_id, w.n_convs, w.n_children::bigint as n_children, n_leaves, saved_tokens, w.ends_sha256
    from whole w join below using (pre) left join whole up on w.depth > 0 and up.pre = w.pre[1:w.depth - 1]"""


SQL = {
    "op3_fixity_audit": _op3(), "op6_line_rules": _op6(), "op7_url_verdicts": _op7(), "op8_chat_formats": _op8(),
    "op11_spelling_variants": _op11(), "op13_prefix_trie": _op13(),
}
