"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from .licenses import SHORT_K, K, template_rows
from .mixing import CAP, GOLDEN, WEIGHTS
from .secrets import RULES

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _grams(table: str, key: str, width: int) -> str:
    """(key, g): distinct shingles of the texts of a table; fewer words are one shingle."""
    words = _WORDS.format(_LOWER.format("coalesce(text, '')"))
    return f"""select distinct {key}, unnest(case when len(w) >= {width} then list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' '))
      when len(w) > 0 then [array_to_string(w, ' ')] else [] end) g from (select {key}, {words} w from {table})"""


SUFFIX = """
with b as (select doc_id, hex(encode(text)) hx, octet_length(encode(text)) n from documents),
p as (select doc_id, pos, row_number() over (partition by s order by doc_id, pos) k from (
      select doc_id, pos, substr(hx, 2 * pos + 1, 200) s from (select doc_id, hx, unnest(range(0, n - 99)) pos from b))),
r as (select doc_id, pos, case when pos <= lag(pos) over (partition by doc_id order by pos) + 100 then 0 else 1 end new from p where k > 1),
q as (select doc_id, pos, sum(new) over (partition by doc_id order by pos) run from r),
s as (select doc_id, min(pos) start, max(pos) + 100 stop from q group by doc_id, run),
t as (select s.*, coalesce(lag(stop) over (partition by doc_id order by start), 0) before from s),
u as (select t.doc_id, string_agg(substr(hx, 2 * before + 1, 2 * (start - before)), '' order by start) kept, max(stop) last_stop, sum(stop - start) gone, count(*) runs
      from t join b on b.doc_id = t.doc_id group by t.doc_id)
select b.doc_id, n n_bytes, cast(coalesce(gone, 0) as bigint) n_removed, coalesce(runs, 0) n_spans,
       sha256(unhex(case when u.doc_id is null then hx else kept || substr(hx, 2 * last_stop + 1) end)) kept_sha256
from b left join u on u.doc_id = b.doc_id"""

JACCARD = f"""
with recursive g as ({_grams("documents", "doc_id", 3)}),
n as (select doc_id, count(*) n from g group by doc_id),
i as (select x.doc_id a, y.doc_id b, count(*) k from g x join g y on x.g = y.g and x.doc_id < y.doc_id group by 1, 2),
l as (select a, b from i join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 90 * (x.n + y.n - k)),
y as (select a, b from l union select b, a from l),
w(doc_id, reach) as (select a, a from y union select w.doc_id, y.b from w join y on w.reach = y.a)
select d.doc_id, coalesce(n.n, 0) n_shingles, coalesce(c.least, d.doc_id) component_id from documents d left join n on n.doc_id = d.doc_id
left join (select doc_id, min(reach) least from w group by doc_id) c on c.doc_id = d.doc_id"""

DECONTAMINATION = f"""
with q as ({_grams("benchmark", "item_id", 5)}), g as ({_grams("documents", "doc_id", 5)}),
n as (select item_id, count(*) n from q group by item_id),
k as (select doc_id, item_id, count(*) k from g join q on q.g = g.g group by 1, 2)
select doc_id, k.item_id, k n_shared, n n_item, k / n containment from k join n on n.item_id = k.item_id where 10 * k >= 8 * n"""


def _secrets() -> str:
    parts = []
    for i, r in enumerate(RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(
            f"select doc_id, '{r.kind}' kind, {i} rank, {int(r.base)} base, {r.least} least, unnest(regexp_split_to_array(text, '{pattern}')) gap, "
            f"unnest(regexp_extract_all(text, '{pattern}', 0)) whole, unnest(regexp_extract_all(text, '{pattern}', {r.group})) part, "
            f"unnest(range(0, len(regexp_extract_all(text, '{pattern}', 0)) + 1)) k from documents where text is not null"
        )
    return f"""
with m as ({" union all ".join(parts)}),
e as (select *, sum(length(gap) + coalesce(length(whole), 0)) over (partition by doc_id, rank order by k) stop from m),
s as (select doc_id, kind, rank, base, cast(stop - length(whole) as bigint) start, kind || ':' || cast(stop - length(whole) as bigint) || ':' || cast(stop as bigint) line from e where length(part) >= least),
a as (select doc_id, count(*) filter (kind = 'assign') n_assign, count(*) filter (kind = 'access') n_access, count(*) filter (kind = 'hex') n_hex,
      coalesce(string_agg(line, ',' order by start, rank) filter (base = 1), '') b, string_agg(line, ',' order by start, rank) spans from s group by doc_id)
select d.doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex, sha256(coalesce(b, '')) base_sha256,
       coalesce(spans, '') spans, sha256(coalesce(text, '')) blob from documents d left join a on a.doc_id = d.doc_id"""


def _mixing() -> str:
    weight = " ".join(f"when {i} then {w}" for i, w in enumerate(WEIGHTS))
    before = "over (order by stop / w, source nulls last rows between unbounded preceding and 1 preceding)"
    return f"""
with d as (select doc_id, source, coalesce(len({_WORDS.format("text")}), 0) size from documents),
s as (select source, cast(sum(size) as bigint) ss, row_number() over (order by source nulls last) r from d group by source),
w as (select source, ss, cast(case (r - 1) % {len(WEIGHTS)} {weight} end as double) w, cast(ss * {CAP} as double) stop from s),
v as (select *, cast(sum(ss) over () as double) total, sum(w) over () w_all, coalesce(sum(stop) {before}, 0) sb, coalesce(sum(w) {before}, 0) wb from w),
x as (select *, (total - sb) / (w_all - wb) level from v),
y as (select *, stop <= level * w stopped, max(case when not (stop <= level * w) then level end) over () free from x),
t as (select source, ss, case when stopped then stop else free * w end target from y),
c as (select greatest(1, least(1024, cast(floor(min(case when target > 0 then target end) / 256) as bigint))) block, cast(sum(ss) as bigint) total from t),
h as (select source, sum(target) over () whole, sum(target) over (order by source nulls last rows between unbounded preceding and current row) upto,
      row_number() over (order by source nulls last) = count(*) over () is_last from t where target > 0),
f as (select source, case when is_last then 4294967296 else cast(floor(upto / whole * 4294967296) as bigint) end hi from h),
g as (select source, coalesce(lag(hi) over (order by source nulls last), 0) lo, hi from f),
j as (select slot, (slot % 2147483648) * {GOLDEN} % 4294967296 u from (select unnest(range(0, (select total // block from c))) slot)),
k as (select g.source, row_number() over (partition by g.source order by slot) - 1 turn from j join g on u >= lo and u < hi),
p as (select doc_id, d.source, size, ss, coalesce(sum(size) over (partition by d.source order by md5(cast(doc_id as varchar) || '-mix') rows between unbounded preceding and 1 preceding), 0) at_word
      from d join t on t.source is not distinct from d.source where size > 0),
q as (select doc_id, source, ss, lap * ss + at_word a, lap * ss + at_word + size b from p, (select unnest(range(0, {CAP})) lap)),
z as (select doc_id, source, a, b, unnest(range(cast(a // block as bigint), cast((b - 1) // block + 1 as bigint))) turn, ss, block from q, c),
n as (select z.doc_id, sum(least(b, (z.turn + 1) * block) - greatest(a, z.turn * block)) taken from z join k on k.turn = z.turn and k.source is not distinct from z.source
      where (z.turn + 1) * block <= ss * {CAP} group by z.doc_id)
select d.doc_id, d.source, size, ss source_size, target, cast(coalesce(taken, 0) as bigint) taken from d join t on t.source is not distinct from d.source left join n on n.doc_id = d.doc_id"""


def _licenses() -> str:
    rows = template_rows()
    grams = [f"({t}, {i}, '{' '.join(w[i : i + k])}')" for t, _, _, w, k in rows for i in range(len(w) - k + 1)]
    facts = [f"({t}, '{label}', {base}, {k < K}, {len(w) - k + 1}, {w})" for t, label, base, w, k in rows]
    words = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    runs = " union all ".join(f"select doc_id, i - 1 pos, array_to_string(w[i:i + {k - 1}], ' ') gram from (select doc_id, w, unnest(range(1, len(w) - {k - 2})) i from w)" for k in (SHORT_K, K))
    return f"""
with m(template, tpos, gram) as (values {", ".join(grams)}), f(template, label, base, exact, total, tw) as (values {", ".join(facts)}),
w as (select doc_id, {words} w from documents), g as ({runs}),
d as (select doc_id, template, pos - tpos diag, count(*) n from g join m on m.gram = g.gram group by all),
n as (select d.*, exact, total, case when not exact and diag - lag(diag) over (partition by doc_id, d.template order by diag) <= 2 then 0 else 1 end new from d join f on f.template = d.template),
b as (select *, sum(new) over (partition by doc_id, template order by diag) band from n),
p as (select *, (diag - min(diag) over (partition by doc_id, template, band)) // 16 piece from b),
s as (select doc_id, template, band, piece, sum(n) n, min(diag) start, any_value(exact) exact, any_value(total) total from p group by all having case when any_value(exact) then sum(n) = any_value(total) else sum(n) >= any_value(total) * 0.1::double end),
t as (select s.doc_id, s.template, s.band, s.piece, x.i, bool_or(diag + x.i >= 1 and w.w[diag + x.i] = x.word) stands
      from s join p on p.doc_id = s.doc_id and p.template = s.template and p.band = s.band and p.piece = s.piece join w on w.doc_id = s.doc_id
      join (select template, unnest(tw) word, unnest(range(1, len(tw) + 1)) i from f) x on x.template = s.template group by all),
v as (select doc_id, template, band, piece, count(*) filter (stands) / count(*) part from t group by all),
k as (select s.doc_id, label, base, start, part from v join s using (doc_id, template, band, piece) join f on f.template = s.template where case when f.exact then part = 1 else part >= 0.75 end),
r as (select doc_id, count(*) filter (base) n_base, min(start) filter (base) first_word, max(start) filter (base) last_word,
      coalesce(string_agg(distinct label, ',' order by label) filter (base), '') base_labels, string_agg(distinct label, ',' order by label) labels, max(part) score from k group by doc_id)
select w.doc_id, len(w) n_words, coalesce(n_base, 0) n_base, first_word, last_word, coalesce(base_labels, '') base_labels, coalesce(labels, '') labels, coalesce(score, 0.0) score
from w left join r on r.doc_id = w.doc_id"""


FILL_IN_MIDDLE = """
with h as (select doc_id, coalesce(text, '') t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) h from documents),
d as (select doc_id, t, length(t) n, cast('0x' || h[1:8] as bigint) h1, cast('0x' || h[9:16] as bigint) h2, cast('0x' || h[17:24] as bigint) h3, cast('0x' || h[25:32] as bigint) h4 from h),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) a, greatest(h1 % (n + 1), h2 % (n + 1)) b,
      case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end form from d),
o as (select *, substr(t, 1, a) p, substr(t, a + 1, b - a) m, substr(t, b + 1) s from c)
select doc_id, n, form, case when form <> 'plain' then a end prefix_chars, case when form <> 'plain' then b - a end middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) output_sha256,
       sha256(t) restored_sha256 from o"""


def _repair() -> str:
    """Least (cost, edits, text) behind each row and state, from the last row to the first; states: start, after s, after u, after a."""
    table = []
    for x in range(256):
        for _ in range(8):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        table.append(x)
    void, more = "fault in ('blank', 'duplicate')", "case when fault = 'truncated' then 5 else 0 end"
    role = {2: "user", 3: "assistant"}

    def put(letter: str, cost: str, line: str, to: str) -> str:
        return f"{{'c': {to}.c + {cost}, 'a': '{letter}' || {to}.a, 't': {line} || {to}.t}}"

    def row(state: int, keeps: dict[str, int], to: int) -> str:
        kept = " ".join(f"when ini = '{i}' then {put('K', more, own, f'v{t}')}" for i, t in keeps.items())
        turned = put("R", f"1 + {more}", f"'{role[to]}:' || text || chr(10)", f"v{to}")
        return f"list_min(list_filter([{put('D', '2', no, f'v{state}')}, case when {void} then null {kept} end, case when not {void} then {turned} end], lambda x: x is not null)) w{state}"

    own, no = "role || ':' || text || chr(10)", "''"
    insert = lambda to, at: put("I", "5", f"'{role[to]}:' || chr(10)", at)
    rows = ", ".join([row(0, {"s": 1, "u": 2}, 2), row(1, {"u": 2}, 2), row(2, {"a": 3}, 3), row(3, {"u": 2}, 2)])
    two = f"list_min([w2, {insert(3, 'w3')}])"
    done = "{'c': 0, 'a': '', 't': ''}"
    start = f"{done} v0, {{'c': 10, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)}} v1, {{'c': 5, 'a': 'I', 't': 'assistant:' || chr(10)}} v2, {done} v3"
    return f"""
with recursive k as (select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text,
      xor(list_reduce([4294967295::bigint] || list_transform(string_split(key, ''), lambda x: ord(x)::bigint), lambda c, b: xor(c >> 8, list_extract({table}, (xor(c, b) & 255) + 1))), 4294967295) % 20 kind
      from (select *, coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') key from conversations)),
d as (select conv_id, turn, case kind when 4 then 'user' else role end role, case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end text,
      unnest(case when kind = 3 then [0, 1] else [0] end) copy from k where kind <> 0),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) i, row_number() over (partition by conv_id, role, text order by turn nulls first, copy) rep,
      rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) r from d),
f as (select conv_id, i, turn, role, text, left(role, 1) ini, case when r = '' then 'blank' when rep > 1 then 'duplicate' when right(r, 1) not in ('.', '!', '?') then 'truncated' else 'sound' end fault from o),
p as (select *, ini || lead(ini) over (partition by conv_id order by i) pair from f),
n as (select conv_id, count(*) n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (fault = 'blank') blank, count(*) filter (fault = 'duplicate') duplicate,
      count(*) filter (fault = 'truncated') truncated, count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) illegal from p group by conv_id),
v as (select conv_id, n i, {start} from n
      union all
      select conv_id, i, list_min([w0, {insert(2, two)}]), list_min([w1, {insert(2, two)}]), {two}, list_min([w3, {insert(2, 'w2')}])
      from (select v.conv_id, v.i - 1 i, {rows} from v join f on f.conv_id is not distinct from v.conv_id and f.i = v.i))
select c.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated, coalesce(illegal, 0) illegal,
       cast(coalesce(v0.c, 0) as bigint) as "cost", coalesce(v0.a, '') audit, sha256(case when coalesce(v0.t, '') = '' then '' else left(v0.t, length(v0.t) - 1) end) repaired_sha256
from (select distinct conv_id from conversations) c left join n on n.conv_id is not distinct from c.conv_id left join v on v.conv_id is not distinct from c.conv_id and v.i = 0"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_suffix_array_dedup": SUFFIX,
        "op3_ngram_jaccard_join": JACCARD,
        "op5_decontamination": DECONTAMINATION,
        "op7_secret_scan": _secrets(),
        "op8_mix_sources": _mixing(),
        "op9_license_scan": _licenses(),
        "op11_conversation_repair": _repair(),
        "op12_fill_in_middle": FILL_IN_MIDDLE,
    }
