"""DuckDB SQL of the operators' queries that SQL can express."""

from __future__ import annotations

from martflow.llm.licences import ENOUGH, TEMPLATES
from martflow.llm.lm import BACKOFF
from martflow.llm.secretscan import BASE_RULES, RULES

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
ALNUM_WORDS = f"regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
TERMS = f"regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
SPACED_WORDS = f"regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+')"


def _shingled(table: str, key: str, words: str, n: int) -> str:
    """(key, s): the distinct n-word shingles, shorter texts as one."""
    return f"""
    select distinct {key}, unnest(case
        when len(w) >= {n} then [array_to_string(w[i:i + {n - 1}], ' ')
                              for i in generate_series(1, len(w) - {n - 1})]
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
    from (select {key}, {words} as w from {table})"""


def _secrets() -> str:
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    found = " union all ".join(
        f"""select row_id, {i} as place, '{r.kind}' as kind, {r.least} as least,
            regexp_extract_all(text, {quoted(r.pattern)}, 0) as f,
            regexp_extract_all(text, {quoted(r.pattern)}, {r.group}) as v,
            string_split_regex(text, {quoted(r.pattern)}) as g from d
            where regexp_matches(text, {quoted(r.pattern)})""" for i, r in enumerate(RULES))
    base = len(BASE_RULES)
    counts = ", ".join(f"count(*) filter (where place = {i}) as n_{r.kind}"
                       for i, r in enumerate(BASE_RULES))
    joined = "string_agg(kind || ':' || st || ':' || en, ',' order by st, place)"
    return f"""
    with d as (select row_number() over () as row_id, doc_id, coalesce(text, '') as text from documents),
    m as ({found}),
    e as (select row_id, place, kind, least, unnest(generate_series(1, len(f))) as i, f, v, g from m),
    p as (select row_id, place, kind, length(v[i]) as n, least,
            cast(sum(length(g[i]) + length(f[i])) over (partition by row_id, place order by i) as bigint) as en,
            length(f[i]) as l from e),
    s as (select row_id, place, kind, en - l as st, en from p where n >= least),
    a as (select row_id, {counts}, {joined} as spans,
            string_agg(kind || ':' || st || ':' || en, ',' order by st, place)
              filter (where place < {base}) as base from s group by row_id)
    select doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in BASE_RULES)},
        sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from d left join a using (row_id)"""


def _licences() -> str:
    postings = ", ".join(f"({i}, '{w}', {at}, {int(key)})"
                         for i, t in enumerate(TEMPLATES) for at, w, key in t.words())
    sizes = ", ".join(f"({i}, '{t.label}', {str(t.base).lower()}, {len(t.words())}, "
                      f"{sum(k for _, _, k in t.words())})" for i, t in enumerate(TEMPLATES))
    return f"""
    with p(template, word, place, is_key) as (values {postings}),
    z(template, label, base, size, n_keys) as (values {sizes}),
    d as (select row_number() over () as row_id, doc_id, {ALNUM_WORDS} as w from documents),
    u as (select row_id, unnest(w) as word, unnest(generate_series(0, len(w) - 1)) as pos from d),
    v as (select row_id, template, pos - place as st, count(*) as met, sum(is_key) as keys_met
          from u join p using (word) group by all),
    f as (select * from v join z using (template) where keys_met = n_keys and met >= {ENOUGH} * size),
    g as (select row_id, count(*) filter (where base) as n_base,
            min(st) filter (where base) as first_word, max(st) filter (where base) as last_word,
            string_agg(distinct label, ',' order by label) filter (where base) as base_labels,
            string_agg(distinct label, ',' order by label) as labels,
            max(met::double / size) as score from f group by row_id)
    select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
        coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
        coalesce(score, 0) as score
    from d left join g using (row_id)"""


ORACLE: dict[str, str] = {
    "op1_secret_scan": _secrets(),
    "op2_near_duplicates": f"""
    with recursive sh as ({_shingled("documents", "doc_id", SPACED_WORDS, 2)}),
    n as (select doc_id, count(*) as n from sh group by doc_id),
    shared as (select a.doc_id as a, b.doc_id as b, count(*) as c
             from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
    links as (select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b
              where 100 * c >= 80 * (x.n + y.n - c)),
    sym as (select a, b from links union select b, a from links),
    reach as (select a, b from sym union select r.a, s.b from reach r join sym s on r.b = s.a),
    low as (select a as doc_id, min(b) as m from reach group by a)
    select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(m, doc_id)) as component_id,
        doc_id = least(doc_id, coalesce(m, doc_id)) as kept
    from documents left join n using (doc_id) left join low using (doc_id)""",
    "op4_contamination": f"""
    with d as ({_shingled("documents", "doc_id", ALNUM_WORDS, 5)}),
    i as ({_shingled("benchmark", "item_id", ALNUM_WORDS, 5)}),
    n as (select item_id, count(*) as n_item from i group by item_id),
    c as (select doc_id, item_id, count(*) as n_shared from d join i using (s) group by all)
    select doc_id, item_id, n_item, n_shared, n_shared / n_item as containment
    from c join n using (item_id) where n_shared >= 0.8 * n_item""",
    "op3_lm_scores": f"""
    with d as (select row_number() over () as row_id, doc_id, {SPACED_WORDS} as w from documents),
    t as (select row_id, unnest(w) as word, unnest(generate_series(1, len(w))) as i from d),
    n as (select count(*) as total from t),
    c as (select word, count(*) as n from t group by word),
    b as (select row_id, i, lag(word) over (partition by row_id order by i) as v, word from t),
    bc as (select v, word, count(*) as n from b where v is not null group by all),
    s as (select row_id, case when b.v is null then ln(c.n) - ln(total)
            when bc.n >= 2 then ln(bc.n) - ln(cv.n)
            else ln({BACKOFF}) + ln(c.n) - ln(total) end as s
          from b join c using (word) left join c cv on cv.word = b.v
          left join bc on bc.v = b.v and bc.word = b.word, n),
    a as (select row_id, sum(s) as s from s group by row_id)
    select doc_id, len(w) as n_words, round(coalesce(s, 0), 6) as log_score,
        case when len(w) > 0 then round(s / len(w), 6) end as mean_log_score
    from d left join a using (row_id)""",
    "op8_neighbours": """
    with e as (select distinct vec_id, embedding::double[] as v from embeddings
               where embedding is not null
                 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
                 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    s as (select q.vec_id as query_id, e.vec_id, list_inner_product(q.v, e.v) as score
          from e q join e on q.vec_id % 20 = 0 and q.vec_id <> e.vec_id),
    r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as n from s)
    select query_id, n::integer as rank, vec_id, score from r where n <= 20""",
    "op9_licences": _licences(),
    "op11_spelling_groups": f"""
    with recursive crc as (select list_transform(range(256), lambda i: list_reduce(
            [i, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda a, x: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) as steps),
    t as (select doc_id, unnest(regexp_extract_all({LOWERED}, '[A-Za-z\u00C0-\u00FF]+')) as run from documents),
    r as (select doc_id, run, count(*) as n from t where length(run) >= 5 group by all),
    h as (select run, n, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(
            string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
            lambda c: case when ord(c) < 128 then [ord(c)::bigint] else [195, ord(c)::bigint - 64] end))),
            lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1]))) as h from r, crc),
    w as (select case when h % 97 = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word,
            sum(n)::bigint as n from h group by 1 having sum(n) >= 3),
    v as (select word, n from w where length(word) >= 5),
    d as (select word, n, i, word[:i - 1] || word[i + 1:] as rest
          from (select word, n, unnest(generate_series(1, length(word))) as i from v)),
    p as (select a.word, b.word as near, b.n as near_n from d a join d b on a.i = b.i and a.rest = b.rest and a.word <> b.word
          union select a.word, b.word, b.n from d a join v b on a.rest = b.word
          union select b.word, a.word, a.n from d a join v b on a.rest = b.word),
    k as (select word, count(*) as n_near, arg_min(near, row(-near_n, near)) as near, max(near_n) as near_n from p group by word),
    f as (select v.word, n, coalesce(n_near, 0) as n_near, case when near_n >= 2 * n then near end as form,
            case when near_n >= 2 * n then near_n end as form_n from v left join k on k.word = v.word),
    g as (select word, form as so_far, 1 as step from f where form is not null
          union all select g.word, f.form, step + 1 from g join f on f.word = g.so_far where f.form is not null),
    e as (select word, arg_max(so_far, step) as root from g group by word)
    select f.word, form, coalesce(root, f.word) as root, n, n_near, form_n from f left join e on e.word = f.word""",
    "op13_ranked_search": f"""
    with d as (select row_number() over () as row_id, doc_id, {TERMS} as w from documents),
    t as (select row_id, unnest(w) as term from d),
    p as (select row_id, term, count(*) as tf from t group by all),
    c as (select count(*) as n_docs, sum(len(w))::bigint as n_terms from d where len(w) > 0),
    m as (select row_id, doc_id, 100 - 90 + ((90 * len(w) * n_docs) // n_terms) as m from d, c where len(w) > 0),
    q as (select distinct item_id, unnest({TERMS}) as term from benchmark),
    f as (select term, floor(1000 * ln((2.0::double * n_docs + 2) / (2 * count(*) + 1)))::bigint as weight
          from p, c where term in (select term from q) group by term, n_docs),
    s as (select item_id, row_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
          from q join f using (term) join p using (term) join m using (row_id) group by all),
    r as (select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as n
          from s where score > 0)
    select item_id, n::integer as rank, doc_id, score from r where n <= 10""",
}
