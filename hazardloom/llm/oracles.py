"""SQL that gives the same rows as queries of the corpus operators, where SQL can express them."""

from __future__ import annotations

OP12 = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * x::double)) as x
           from embeddings
           where vec_id is not null and label is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same, list_inner_product(a.x, b.x)::bigint as score
      from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
p as (select anchor_id, other as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by anchor_id order by score desc, other) <= 5),
n as (select p.*, s.other as negative_id, s.score as negative_score,
             row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.other) as rank
      from p join s on s.anchor_id = p.anchor_id and not s.same
        and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= 3
"""

OP13 = r"""
with texts as (select coalesce(lang, 'und') as lang,
                      regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as pieces
               from documents),
pieces as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from (select lang, unnest(pieces) as piece from texts)),
f as (select lang, k, phrase, count(*) as f
      from (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
            from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from pieces, (select unnest(range(1, 6)) as k)))
      group by all),
totals as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
c as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from f where k >= 2 and f >= 100),
inside as (select lang, phrase, max(a) as most
           from (select lang, a, array_to_string(w[i:i + m - 1], ' ') as phrase
                 from (select lang, a, w, m, unnest(range(1, k - m + 2)) as i
                       from (select lang, a, w, k, unnest(range(2, k)) as m from c)))
           group by all),
cuts as (select lang, phrase, a, cut, array_to_string(w[1:cut], ' ') as lp, array_to_string(w[cut + 1:], ' ') as rp
         from (select *, unnest(range(1, k)) as cut from c)),
s as (select cuts.lang, cuts.phrase, a, cut, x.f as l, y.f as r, n,
             ((1000::hugeint * a * n) // (x.f::hugeint * y.f))::bigint as score
      from cuts join f x on x.lang = cuts.lang and x.phrase = lp join f y on y.lang = cuts.lang and y.phrase = rp
      join totals on totals.lang = cuts.lang),
best as (select * from s qualify row_number() over (partition by lang, phrase order by score, cut) = 1)
select best.lang, row_number() over (partition by best.lang order by score desc, a desc, best.phrase) as rank, best.phrase, a, l, r, n, score
from best left join inside on inside.lang = best.lang and inside.phrase = best.phrase
where most is null or 100 * most < 100 * a
qualify row_number() over (partition by best.lang order by score desc, a desc, best.phrase) <= 2000
"""
