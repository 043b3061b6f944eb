"""The registered queries once more as plain SQL, for checking results with another engine.

Each query is a chain of named subqueries; `_chain` pulls in the ones it needs.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from lexiquarry.functions import text as tx
from lexiquarry.functions.fixed import (
    ANALYZER_STOP_WORDS,
    NOUN_EXCEPTIONS,
    NOUN_SUFFIX_RULES,
    STOP_WORDS,
    ascii_spellings,
)
from lexiquarry.functions.porter import stem_word
from lexiquarry.operators.fuzzy import allowed_edits
from lexiquarry.operators.search import MatchQuery, required_matches
from lexiquarry.sources.corpus import FIRST_SENTENCE


def _quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(words: Sequence[str]) -> str:
    return ", ".join(_quote(w) for w in words)


def _ascii_sql(column: str) -> str:
    source, target, longer = ascii_spellings()
    spelled = f"translate({column}, {_quote(source)}, {_quote(target)})"
    for char, spelling in longer.items():
        spelled = f"replace({spelled}, {_quote(char)}, {_quote(spelling)})"
    return (f"case when strlen({column}) = length({column}) then {column} "
            f"else regexp_replace({spelled}, '[^\\x00-\\x7F\\p{{L}}]', '', 'g') end")


def _groups(replacement: str) -> str:
    return re.sub(r"\$(\d)", r"\\\1", replacement)


def _standard_sql(column: str) -> str:
    places = "".join(f"chr({ord(c)}) || " for c in tx.ANALYZER_PLACEHOLDERS).removesuffix(" || ")
    text = f"lower(translate({column}, {places}, {_quote(' ' * len(tx.ANALYZER_PLACEHOLDERS))}))"
    for pattern in (tx.ANALYZER_LETTER_JOINT, tx.ANALYZER_DIGIT_JOINT):
        for _ in range(2):
            text = f"regexp_replace({text}, {_quote(pattern)}, '\\1' || chr(1) || '\\2\\3', 'g')"
    for joint, place in zip(tx.ANALYZER_JOINTS, tx.ANALYZER_PLACEHOLDERS[1:], strict=True):
        text = f"replace({text}, chr(1) || {_quote(joint)}, chr({ord(place)}))"
    text = f"regexp_replace({text}, {_quote(tx.ANALYZER_NON_WORD)}, ' ', 'g')"
    places = "".join(f"chr({ord(c)}) || " for c in tx.ANALYZER_PLACEHOLDERS[1:]).removesuffix(" || ")
    text = f"trim(translate({text}, {places}, {_quote(tx.ANALYZER_JOINTS)}))"
    return f"list_filter(string_split({text}, ' '), lambda w: w <> '')"


MARK = "chr(1)"
STEPS: dict[str, tuple[list[str], str]] = {}


def _step(name: str, needs: list[str], sql: str) -> None:
    STEPS[name] = (needs, sql)


def _chain(main: str, *needs: str, extra: dict[str, tuple[list[str], str]] | None = None) -> str:
    steps = {**STEPS, **(extra or {})}
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for need in steps[name][0]:
            visit(need)
        order.append(name)

    for need in needs:
        visit(need)
    if not order:
        return main
    return "with " + ",\n".join(f"{n} as materialized ({steps[n][1]})" for n in order) + "\n" + main


_step("corpus_raw", [], rf"""
  select doc_id, regexp_extract(text, '{FIRST_SENTENCE}', 1) title, text abstract, lang, source,
         case when doc_id % 10 = 0 then '2020' when doc_id % 10 = 1 then null
              else strftime(date '2020-01-01' + cast(doc_id % 700 as int), '%Y-%m-%d') end publish_raw
  from documents""")
_step("corpus", ["corpus_raw"], r"""
  select *, case when regexp_full_match(publish_raw, '\d{4}-\d{1,2}-\d{1,2}')
                 then try_cast(publish_raw as date) end publish_time
  from corpus_raw""")
_step("field_text", ["corpus"], """
  select doc_id, 'pr_title' field, title text from corpus
  union all select doc_id, 'pr_abstract', abstract from corpus""")
_step("folded", ["field_text"], f"""
  select doc_id, field, text, lower({_ascii_sql('text')}) t from field_text""")
_step("marked", ["folded"], f"""
  select doc_id, field, text,
         regexp_replace(regexp_replace(t, '\\s+$', ''), {_quote(tx.SENTENCE_END)}, '\\1' || {MARK}, 'g') t
  from folded""")
_step("stops", ["folded"], r"""
  select word, count(*) filter (stop) n_stop, count(*) filter (not stop) n_plain from (
    select regexp_replace(token, '\.$', '') word, suffix(token, '.') stop from (
      select unnest(string_split(trim(regexp_replace(t, '\s+', ' ', 'g')), ' ')) token from folded))
  where regexp_full_match(word, '[a-z]+(\.[a-z]+)*') group by word""")
_step("abbr", ["stops"], """
  select word, n_stop, n_plain, round(-2e0
           * (n_stop * ln(share) + case when n_plain > 0 then n_plain * ln(1 - share) else 0 end
              - (n_stop * ln(0.99e0) + n_plain * ln(1 - 0.99e0)))
           * exp(-letters::double) * (length(word) - letters + 1) * exp(-n_plain * ln(letters::double)), 9) score
  from (select *, length(replace(word, '.', '')) letters,
               (select sum(n_stop)::double / sum(n_stop + n_plain) from stops) share from stops where n_stop > 0)""")
_step("normal", ["marked"], f"""
  select doc_id, field, case when regexp_full_match(text, '\\s*') then [] else string_split_regex(
    regexp_replace(trim(regexp_replace(t, {_quote(tx.NON_WORD_RUN)}, ' ', 'g')),
                   {_quote(tx.FUSED_WORDS)}, {_quote(_groups(tx.FUSED_WORDS_APART))}, 'g'),
    ' ?\\x01 ?') end sentences
  from marked""")
_step("sent", ["normal"], """
  select doc_id, field, cast(generate_subscripts(sentences, 1) - 1 as bigint) sent_no,
         unnest(sentences) sentence
  from normal""")
_step("tok", ["sent"], """
  select doc_id, field, sent_no, cast(pos - 1 as bigint) pos, word from (
    select doc_id, field, sent_no, generate_subscripts(ws, 1) pos, unnest(ws) word from (
      select doc_id, field, sent_no, string_split(sentence, ' ') ws from sent where sentence <> ''))""")
# Position over the whole field, from 0.
_step("word", ["tok"], """
  select doc_id, field, word term,
         row_number() over (partition by doc_id, field order by sent_no, pos) - 1 pos
  from tok""")
_step("post", ["word"], """
  select doc_id, field, term, count(*) tf from word group by all""")
_step("dl", ["word"], """
  select doc_id, field, count(*) dl from word group by all""")
_step("df", ["post"], """
  select field, term, count(*) df from post group by all""")
_step("fs", ["dl"], """
  select field, count(*) n_docs, cast(sum(dl) as double) / count(*) avgdl from dl group by all""")


# ---------------------------------------------------------------- keywords

_step("kw", ["sent"], f"""
  select doc_id, field, sent_no, array_to_string(list_filter(string_split(sentence, ' '),
    lambda w: length(w) > 2 and w not in ({_values([w for w in STOP_WORDS if len(w) > 2])})), ' ') sentence
  from sent""")
_step("kwtok", ["kw"], """
  select doc_id, field, sent_no, cast(pos - 1 as bigint) pos, word from (
    select doc_id, field, sent_no, generate_subscripts(ws, 1) pos, unnest(ws) word from (
      select doc_id, field, sent_no, string_split(sentence, ' ') ws from kw where sentence <> ''))""")
_step("kwflat", ["kwtok"], """
  select doc_id, field, word, lead(word, 1) over w w2, lead(word, 2) over w w3, lead(word, 3) over w w4
  from kwtok window w as (partition by doc_id, field order by sent_no, pos)""")
_step("uni", ["kwtok"], "select word, count(*) n from kwtok group by all")
_step("bi", ["kwflat"], """
  select word w1, w2, count(*) n from kwflat where w2 is not null group by all""")
_step("tri", ["kwflat"], """
  select word w1, w2, w3, count(*) n from kwflat where w3 is not null group by all""")
_step("bipmi", ["bi", "uni"], """
  select w1 || ' ' || w2 gram, bi.n, log2(bi.n * (select sum(n) from uni)::double)
         - log2(a.n::double * b.n::double) pmi
  from bi join uni a on a.word = w1 join uni b on b.word = w2 where bi.n >= 7""")
_step("tripmi", ["tri", "uni"], """
  select w1 || ' ' || w2 || ' ' || w3 gram, tri.n,
         log2(tri.n * pow((select sum(n) from uni)::double, 2))
         - log2(a.n::double * b.n::double * c.n::double) pmi
  from tri join uni a on a.word = w1 join uni b on b.word = w2 join uni c on c.word = w3
  where tri.n >= 5""")
_step("topuni", ["uni"], """
  select row_number() over (order by n desc, word) rank, word, n from uni
  qualify rank <= 1000""")
_step("freqdict", ["topuni", "bipmi"], """
  select word phrase, word clean, 1 n_words, n::double score from topuni
  union all select gram, replace(gram, ' ', '_'), 2, pmi from bipmi""")

# TextRank.
_step("tr_pairs", ["kwflat"], """
  select doc_id, field, word a, unnest([w2, w3, w4]) b from kwflat""")
_step("tr_edges", ["tr_pairs"], """
  select doc_id, field, a, b, count(*) n from (
    select doc_id, field, a, b from tr_pairs where b <> a
    union all select doc_id, field, b, a from tr_pairs where b <> a) group by all""")
_step("tr_links", ["tr_edges"], """
  select doc_id, field, a, b, n / sum(n) over (partition by doc_id, field, b) share from tr_edges""")
_step("tr_0", ["kwtok"], """
  select doc_id, field, word, n_nodes, 1e0 / n_nodes rank from (
    select doc_id, field, word, count(*) over (partition by doc_id, field) n_nodes
    from (select distinct doc_id, field, word from kwtok))""")
for _i in range(1, 21):
    _step(f"tr_{_i}", [f"tr_{_i - 1}", "tr_links"], f"""
      select r.doc_id, r.field, r.word, r.n_nodes,
             case when r.n_nodes = 1 then 1e0
                  else 0.15e0 / r.n_nodes + 0.85e0 * coalesce(s.flow, 0) end rank
      from tr_{_i - 1} r left join (
        select l.doc_id, l.field, l.a word, sum(p.rank * l.share) flow
        from tr_links l join tr_{_i - 1} p on p.doc_id = l.doc_id and p.field = l.field and p.word = l.b
        group by all) s using (doc_id, field, word)""")
_step("tr_runs", ["kwtok", "tr_20"], """
  select *, pos - row_number() over (partition by doc_id, field, sent_no order by pos) run
  from kwtok join tr_20 using (doc_id, field, word) where round(rank * n_nodes, 6) >= 1""")
_step("tr_phrases", ["tr_runs"], """
  select doc_id, field, phrase, max(n_words) n_words, max(score) score from (
    select doc_id, field, string_agg(word, ' ' order by pos) phrase, count(*) n_words,
           sqrt(sum(rank) / count(*)) score
    from tr_runs group by doc_id, field, sent_no, run)
  where round(score, 9) >= 0.05 group by doc_id, field, phrase""")
_step("trdict", ["tr_phrases"], """
  select phrase, replace(phrase, ' ', '_') clean, any_value(n_words) n_words, max(score) score
  from tr_phrases group by phrase""")

# Dictionary matches.
_step("dict", ["freqdict", "trdict"], """
  select 'frequent' source, phrase, clean from freqdict
  union all select 'textrank', phrase, clean from trdict""")
_step("spans", ["kwtok"], """
  select doc_id, field, sent_no, pos start, k n_words,
         case k when 1 then word when 2 then word || ' ' || b else word || ' ' || b || ' ' || c end phrase
  from (select *, lead(word, 1) over w b, lead(word, 2) over w c from kwtok
        window w as (partition by doc_id, field, sent_no order by pos)), (select unnest([1, 2, 3]) k)
  where phrase is not null""")
_step("long_spans", ["spans", "dict", "kwtok"], """
  select doc_id, field, sent_no, start, n n_words, whole phrase
  from (select distinct phrase whole, string_split(phrase, ' ') parts, len(string_split(phrase, ' ')) n from dict)
       join spans on n > 3 and n_words = 3 and phrase = array_to_string(parts[1:3], ' ')
       join (select doc_id, field, sent_no, list(word order by pos) ws from kwtok group by all)
            using (doc_id, field, sent_no)
  where ws[start + 1:start + n] = parts""")
_step("matches", ["spans", "long_spans", "dict"], """
  select doc_id, field, sent_no, source, m.s start, m.n n_words, m.c clean from (
    select doc_id, field, sent_no, source, unnest(list_reduce(list_transform(ms, lambda x: [x]),
      lambda a, b: case when a[-1].s + a[-1].n <= b[1].s then list_concat(a, b) else a end)) m
    from (select doc_id, field, sent_no, source,
                 list({'s': start, 'n': n_words, 'c': clean} order by start, n_words desc) ms
          from (select doc_id, field, sent_no, start, n_words, phrase from spans
                union all select * from long_spans) join dict using (phrase) group by all))""")
_step("matched", ["kw", "matches"], """
  select doc_id, field, sent_no, coalesce(t, []) t, coalesce(f, []) f from kw left join (
    select doc_id, field, sent_no, list(clean order by start) filter (source = 'textrank') t,
           list(clean order by start) filter (source = 'frequent') f
    from matches group by all) using (doc_id, field, sent_no)""")
# First occurrence of each element that the other list lacks.
_NEW_IN = """list_filter({b}, lambda x, i: not list_contains({a}, x) and list_position({b}, x) = i)"""
_step("merged", ["matched"], f"""
  select doc_id, field, sent_no, list_concat(t, {_NEW_IN.format(a='t', b='f')}) kws from matched""")


def _tfidf_steps(prefix: str, tokens: str, documents: str) -> None:
    """Weights of the words in step `tokens` (doc_id, field, word); `documents` has (doc_id, field)."""
    _step(f"{prefix}tf", [tokens], f"""
      select doc_id, field, word term, count(*) tf from {tokens} where length(word) >= 2 group by all""")
    _step(f"{prefix}tfidf", [f"{prefix}tf", documents], f"""
      select doc_id, field, term, tf, v / sqrt(sum(v * v) over (partition by doc_id, field)) tfidf from (
        select doc_id, field, term, tf, tf * (ln((1 + n) / (1 + df)) + 1) v
        from {prefix}tf join (select field, term, count(*) df from {prefix}tf group by all) using (field, term)
             join (select field, count(*) n from {documents} group by all) using (field))""")
    _step(f"{prefix}terms", [f"{prefix}tfidf"], f"""
      select doc_id, field, term from {prefix}tfidf where round(tfidf, 9) > 0.09""")


_tfidf_steps("", "kwtok", "normal")
_step("mergetok", ["merged"], """
  select doc_id, field, sent_no, cast(generate_subscripts(kws, 1) - 1 as bigint) pos, unnest(kws) word
  from merged""")
_tfidf_steps("m_", "mergetok", "normal")
_step("reduced", ["kw", "kwtok", "terms"], """
  select doc_id, field, sent_no, coalesce(s, '') s from kw left join (
    select doc_id, field, sent_no, string_agg(replace(word, '_', ' '), ' ' order by pos) s
    from kwtok semi join terms on terms.doc_id = kwtok.doc_id and terms.field = kwtok.field
         and terms.term = kwtok.word
    group by all) using (doc_id, field, sent_no)""")

# Base forms.
_step("lexicon", ["df"], "select distinct term form from df where df >= 2")
_RULES = " ".join(
    f"union all select word, left(word, length(word) - {len(s)}) || {_quote(e)} from w where suffix(word, {_quote(s)})"
    for s, e in NOUN_SUFFIX_RULES)
_IRREGULAR = ", ".join(f"({_quote(w)}, {_quote(b)})" for w, b in NOUN_EXCEPTIONS)
_step("allwords", ["tok"], "select distinct word from tok")
_step("lemma", ["allwords", "lexicon"], f"""
  with w as (select word from allwords),
  forms as (select word, word form from w {_RULES}
            union all select word, base from w join (values {_IRREGULAR}) x(word, base) using (word))
  select word, coalesce(form, word) lemma from w left join (
    select word, form from forms join lexicon using (form) where form <> ''
    qualify row_number() over (partition by word order by length(form), form) = 1) using (word)""")

# Index words of the full pipeline, and both pipelines together.
_step("s1word", ["mergetok", "m_terms", "lemma"], """
  select doc_id, field, lemma term from (
    select doc_id, field, unnest(string_split(replace(word, '_', ' '), ' ')) word
    from mergetok semi join m_terms t on t.doc_id = mergetok.doc_id and t.field = mergetok.field
         and t.term = mergetok.word) join lemma using (word)""")
_step("word_s1", ["s1word"], "select doc_id, field, term from s1word")
_step("word_both", ["s1word", "word"], """
  select doc_id, 'System_1.' || field field, term from s1word
  union all select doc_id, 'System_2.' || field, term from word""")
_step("raw_text", ["corpus"], """
  select doc_id, 'title' field, title text from corpus
  union all select doc_id, 'abstract', abstract from corpus""")
_step("word_raw", ["raw_text"], f"""
  select doc_id, field, unnest({_standard_sql('text')}) term from raw_text""")
for _s in ("_s1", "_both", "_raw"):
    _step(f"post{_s}", [f"word{_s}"], f"select doc_id, field, term, count(*) tf from word{_s} group by all")
    _step(f"dl{_s}", [f"word{_s}"], f"select doc_id, field, count(*) dl from word{_s} group by all")
    _step(f"df{_s}", [f"post{_s}"], f"select field, term, count(*) df from post{_s} group by all")
    _step(f"fs{_s}", [f"dl{_s}"], f"""
      select field, count(*) n_docs, cast(sum(dl) as double) / count(*) avgdl from dl{_s} group by all""")


# ---------------------------------------------------------------- ranked search

def _clauses(query: MatchQuery) -> list[str]:
    """Analysed terms of an ASCII query text."""
    words = re.findall(r"[a-z0-9]+(?:'[a-z]+)?", query.text.lower())
    if query.analyzer == "english":
        words = [re.sub("'s$", "", w) for w in words]
        words = [stem_word(w) for w in words if w not in ANALYZER_STOP_WORDS]
    return words


def distance_sql(a: str, b: str) -> str:
    """Optimal string alignment distance of two columns up to 2, 3 for more.

    The engine's own function may edit a swapped pair once more. With two edits that shows where plain edits do not
    suffice: then some swap must part both words into halves that are one edit apart at most.
    """
    own = f"damerau_levenshtein({a}, {b})"
    halves = (f"damerau_levenshtein(left({a}, i - 1), left({b}, j - 1)) "
              f"+ damerau_levenshtein(substr({a}, i + 2), substr({b}, j + 2)) <= 1")
    swap = (f"len(list_filter(range(1, length({a})), lambda i: len(list_filter([i - 1, i, i + 1], lambda j: j >= 1 "
            f"and substr({b}, j, 2) = reverse(substr({a}, i, 2)) and {halves})) > 0)) > 0")
    return f"case when {own} > 2 then 3 when {own} < 2 or levenshtein({a}, {b}) <= 2 or {swap} then {own} else 3 end"


def _search_steps(queries: Sequence[MatchQuery], prefix: str = "", suffix: str = "") -> dict:
    """Subqueries ending in `scored` (query_id, doc_id, score) and `hits` (… rank)."""
    rows, heads = [], []
    for q in queries:
        clauses = _clauses(q)
        need = required_matches(q.minimum_should_match, len(clauses))
        for name, boost in q.fields.items():
            heads.append(f"('{q.query_id}', '{name}', {float(boost)}e0, {need}, {q.size})")
            for i, term in enumerate(clauses):
                edits = 0 if q.fuzziness is None else allowed_edits(q.fuzziness, term)
                rows.append(f"('{q.query_id}', {i}, '{name}', '{term}', {edits})")
    p = prefix
    filters = " and ".join(
        f"(query_id <> '{q.query_id}' or {q.between[0]} between date '{q.between[1]}' and date '{q.between[2]}')"
        for q in queries if q.between) or "true"
    return {
        f"{p}qt": ([], f"select * from (values {', '.join(rows)}) v(query_id, clause_no, field, qterm, edits)"),
        f"{p}qf": ([], f"select * from (values {', '.join(heads)}) v(query_id, field, boost, need, size)"),
        f"{p}near": ([f"{p}qt", f"df{suffix}"], f"""
          select query_id, clause_no, field, qterm, term, df, {distance_sql("qterm", "term")} dist
          from {p}qt join df{suffix} using (field)
          where abs(length(term) - length(qterm)) <= edits and damerau_levenshtein(qterm, term) <= edits
            and {distance_sql("qterm", "term")} <= edits"""),
        f"{p}expanded": ([f"{p}near"], f"""
          select *, 1 - dist / least(length(qterm), length(term)) weight,
                 max(df) over (partition by query_id, clause_no, field) max_df
          from (select *, row_number() over (partition by query_id, clause_no, field order by dist, term) n
                from {p}near) where n <= 50"""),
        f"{p}clause_score": ([f"{p}expanded", f"post{suffix}", f"dl{suffix}", f"fs{suffix}"], f"""
          select query_id, clause_no, field, doc_id,
                 max(weight * ln(1 + (n_docs - max_df + 0.5e0) / (max_df + 0.5e0))
                     * tf / (tf + 1.2e0 * (1 - 0.75e0 + 0.75e0 * dl / avgdl))) score
          from {p}expanded join post{suffix} using (field, term) join dl{suffix} using (field, doc_id)
               join fs{suffix} using (field)
          group by all"""),
        f"{p}scored": ([f"{p}clause_score", f"{p}qf", "corpus"], f"""
          select query_id, doc_id, round(max(score), 12) score from (
            select query_id, field, doc_id, sum(score) * any_value(boost) score
            from {p}clause_score join {p}qf using (query_id, field)
            group by query_id, field, doc_id having count(*) >= any_value(need))
          join corpus using (doc_id) where {filters}
          group by query_id, doc_id"""),
        f"{p}hits": ([f"{p}scored", f"{p}qf"], f"""
          select query_id, rank, doc_id, score from (
            select *, row_number() over (partition by query_id order by score desc, doc_id) rank from {p}scored)
          join (select distinct query_id, size from {p}qf) using (query_id) where rank <= size"""),
    }


def search_sql(queries: Sequence[MatchQuery], main: str, *needs: str, suffix: str = "") -> str:
    return _chain(main, *needs, extra=_search_steps(queries, suffix=suffix))
