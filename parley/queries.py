"""One query per operator over the synthetic tables, and independent DuckDB SQL for each."""

from __future__ import annotations

import unicodedata
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import lexicons as L
from parley.functions import unicode
from parley.operators import augment, chat, clean, enrich, profile, report, score, split, template, tokens, validate
from parley.sources import io
from parley.sources.io import INTERACTIONS_SQL, interactions, over_turns, scratch

KEYS = ("row_id",)


def _documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _scored(spark, sf_dir):
    return score.with_scores(interactions(spark, sf_dir))


def _enriched(spark, sf_dir):
    return enrich.enrich(interactions(spark, sf_dir))


def _formatted(spark, sf_dir):
    return chat.formatted(_enriched(spark, sf_dir))


def _raw_docs(spark, sf_dir):
    """A table with nulls, blanks, repeats and rows without letters, for the row rules."""
    return over_turns(_documents(spark, sf_dir, "conversations"), _DIRTY.format(base=INTERACTIONS_SQL))


_DIRTY = """
SELECT row_id, CASE WHEN row_id % 11 = 3 THEN NULL WHEN row_id % 13 = 5 THEN '  ' WHEN row_id % 17 = 2 THEN '???' WHEN row_id % 7 = 1 THEN '  same?? question' ELSE instruction END AS instruction,
  CASE WHEN row_id % 19 = 4 THEN NULL WHEN row_id % 7 = 1 THEN 'one... answer' ELSE response END AS response, category, intent, flags
FROM ({base}) b
"""


def eda_profile(spark, sf_dir):
    return profile.profile(interactions(spark, sf_dir))


def eda_length_stats(spark, sf_dir):
    return profile.length_stats(interactions(spark, sf_dir))


def eda_length_histogram(spark, sf_dir):
    return profile.length_histogram(interactions(spark, sf_dir))


def eda_category_dist(spark, sf_dir):
    return profile.value_counts(interactions(spark, sf_dir), "category")


def eda_intent_top20(spark, sf_dir):
    return profile.top_values(interactions(spark, sf_dir), "intent", 20)


def eda_dist_grouping_sets(spark, sf_dir):
    return profile.distributions(interactions(spark, sf_dir), ("category", "intent"))


def clean_text_docs(spark, sf_dir):
    rows = _documents(spark, sf_dir).select("doc_id", clean.clean_instruction(F.col("text")).alias("as_instruction"))
    return rows.withColumn("as_response", clean.sentence_capitals(F.col("as_instruction")))


def clean_pages_unescape(spark, sf_dir):
    return _documents(spark, sf_dir, "pages").select("page_id", unicode.unescape(F.col("html")).alias("html"))


#: Letters and signs put in other forms of Unicode: full width, ligatures, signs for words, parts and marks, jamo.
_FORMS = {"The": "Ｔｈｅ", "De": "㏈e", "é": "é", "ñ": "ñ", "ü": "ǘ", "fi": "ﬁ", "On": "Ō̱n", "1": "①", "2": "²½", "Er": "각ｶﾞr", "...": "…", "A": "Å", "S": "ẛ̣"}


def _other_forms(c: Column) -> Column:
    for plain, form in _FORMS.items():
        c = F.replace(c, F.lit(plain), F.lit(form))
    return c


def clean_nfkc(spark, sf_dir):
    """The documents with many letters in other forms, brought to NFKC."""
    return _documents(spark, sf_dir).select("doc_id", unicode.nfkc(_other_forms(F.col("text"))).alias("text"))


def clean_dedupe_first(spark, sf_dir):
    return clean.clean(_raw_docs(spark, sf_dir)).select("row_id", "instruction", "response")


def clean_removal_report(spark, sf_dir):
    return clean.removal_report(_raw_docs(spark, sf_dir))


def _score_query(column: str):
    def query(spark, sf_dir):
        return _scored(spark, sf_dir).select("row_id", column)

    return query


def quality_filter(spark, sf_dir):
    return score.passing(interactions(spark, sf_dir), 7.0).select("row_id", "quality_score")


def quality_report(spark, sf_dir):
    return score.report(interactions(spark, sf_dir), 7.0)


def _label_query(column: str):
    def query(spark, sf_dir):
        return _enriched(spark, sf_dir).select("row_id", column)

    return query


def enrich_distributions(spark, sf_dir):
    return profile.distributions(_enriched(spark, sf_dir), enrich.LABELS)


def augment_short_form(spark, sf_dir):
    return interactions(spark, sf_dir).select("row_id", augment.short_form().alias("instruction"))


def augment_long_form(spark, sf_dir):
    return interactions(spark, sf_dir).select("row_id", augment.long_form().alias("instruction"))


def augment_paraphrase(spark, sf_dir):
    return interactions(spark, sf_dir).select("row_id", augment.paraphrase().alias("instruction"), augment.rewritten_response().alias("response"))


def augment_typos(spark, sf_dir):
    return interactions(spark, sf_dir).select("row_id", augment.typos().alias("instruction"))


def augment_all_dist(spark, sf_dir):
    return augment.augment(interactions(spark, sf_dir)).groupBy("augmentation_type", "is_augmented").agg(F.count("*").alias("n"))


def format_alpaca(spark, sf_dir):
    return _formatted(spark, sf_dir).select("row_id", chat.json_of(F.col("alpaca")).alias("json"))


def format_chatml(spark, sf_dir):
    return _formatted(spark, sf_dir).select("row_id", chat.json_of(F.col("chatml")).alias("json"))


def format_messages(spark, sf_dir):
    return _formatted(spark, sf_dir).select("row_id", chat.json_of(F.struct("messages", "metadata")).alias("json"))


def render_template(spark, sf_dir):
    return _formatted(spark, sf_dir).select("row_id", chat.rendered(F.col("messages")).alias("text"))


def render_prompt(spark, sf_dir):
    return _formatted(spark, sf_dir).select("row_id", chat.prompt(F.col("messages")).alias("text"))


#: Two layouts in the language of tokenizer files.
TEMPLATES = {
    "chatml": r"""{% for message in messages %}
{{ '<|im_start|>' + message['role'] + '\n' + message['content'] + '<|im_end|>' + '\n' }}
{%- endfor %}
{% if add_generation_prompt %}
{{ '<|im_start|>assistant\n' }}
{%- endif %}
""",
    "instructions": r"""{{ bos_token }}
{%- for message in messages %}
    {%- if message.role == 'system' %}
        {%- if loop.first %}{{ '<<SYS>>\n' + message.content + '\n<</SYS>>\n' }}{% endif %}
    {%- elif message.role == 'user' %}
        {{- '[INST] ' + (message.content | trim) + ' [/INST]' }}
    {%- else %}
        {{- ' ' + message.content + eos_token }}{% if not loop.last %}{{ '\n' }}{% endif %}
    {%- endif %}
{%- endfor %}""",
}


def render_files(spark, sf_dir):
    """Both layouts, and the first one open for an answer."""
    m = F.col("messages")
    texts = {"chatml": template.compiled(TEMPLATES["chatml"], m), "prompt": template.compiled(TEMPLATES["chatml"], F.slice(m, 1, 2), True), "instructions": template.compiled(TEMPLATES["instructions"], m, bos_token="<s>", eos_token="</s>")}
    return _formatted(spark, sf_dir).select("row_id", *[c.alias(k) for k, c in texts.items()])


def validate_rows(spark, sf_dir):
    return validate.validate_rows(_raw_docs(spark, sf_dir), 150, 1_000)


def validate_formats(spark, sf_dir):
    return validate.validate_formats(chat.formatted(enrich.enrich(_raw_docs(spark, sf_dir))))


def token_estimates(spark, sf_dir):
    return tokens.token_counts(_formatted(spark, sf_dir))


def token_stats(spark, sf_dir):
    return tokens.token_stats(_formatted(spark, sf_dir))


def split_assign(spark, sf_dir):
    return split.split(interactions(spark, sf_dir)).select("row_id", "split")


def split_sizes(spark, sf_dir):
    return split.split_sizes(interactions(spark, sf_dir))


def split_intent_dist(spark, sf_dir):
    return split.intent_counts(interactions(spark, sf_dir))


def sample_k(spark, sf_dir):
    return split.sample(interactions(spark, sf_dir), 20).select("row_id", "instruction")


def report_progression(spark, sf_dir):
    return report.stages(_raw_docs(spark, sf_dir), 7.0)


def report_headline(spark, sf_dir):
    return report.headline(_raw_docs(spark, sf_dir), 7.0)


def eda_distinct(spark, sf_dir):
    return profile.distinct_counts(interactions(spark, sf_dir))


#: Records that break a rule or keep one in an unusual way, for every format.
_RECORDS = (
    "no json", "[]", "{}", "null", "5", '"text"', '{"instruction": null, "input": [], "output": {}, "more": 1}', '{"instruction": "x", "output": "y"}', '{"messages": {}}', '{"messages": [1, 2]}',
    '{"messages": [{"role": "user", "content": "x"}]}', '{"messages": [{"role": "user", "content": "x"}, {"role": "tool", "content": null}]}',
    '{"metadata": {}, "messages": [{"role": "user", "content": "x"}, {"role": "assistant"}, {}]}', '[{"role": "user", "content": "x"}, {"role": "user", "content": "y"}]',
    '[{"role": "user", "content": null}, {"role": "assistant", "content": [1]}]', '[{"role": "user", "content": "x"}, 7]', '[{"content": "x"}, {"role": "assistant", "content": "y"}]',
    '[{"role": "user", "content": "x"}, {"role": "assistant", "content": "y"}, {"role": "user", "content": "z"}]', '[{"role": 1, "content": "x"}, {}]',
)


def _json_lines(spark, sf_dir):
    """Chat formats as JSON text; some rows have another record, some only the first half of theirs."""
    rows = _formatted(spark, sf_dir)
    number = F.floor(F.col("row_id") / 4) % len(_RECORDS)

    def spoilt(c):
        return F.when(F.col("row_id") % 4 == 0, F.get(F.array(*map(F.lit, _RECORDS)), number.cast("int"))).when(F.col("row_id") % 9 == 5, F.substr(c, F.lit(1), (F.length(c) / 2).cast("int"))).otherwise(c)

    texts = {"alpaca": F.col("alpaca"), "chatml": F.col("chatml"), "messages": F.struct("messages", "metadata")}
    return rows.select("row_id", *[spoilt(chat.json_of(c)).alias(k) for k, c in texts.items()])


def validate_json_formats(spark, sf_dir):
    rows = _json_lines(spark, sf_dir)
    errors = rows.select("row_id", *[validate.json_error(F.col(k), k).alias(k) for k in validate.JSON_ERRORS])
    return errors.select("row_id", *[x for k in validate.JSON_ERRORS for x in (F.col(k).isNull().alias(f"{k}_valid"), F.coalesce(f"{k}.rule", F.lit("")).alias(f"{k}_rule"), F.coalesce(f"{k}.place", F.lit(-1)).alias(f"{k}_place"))])


#: Bytes that no UTF-8 text has, by what is wrong with them.
_BAD_BYTES = ("80", "C080", "EDA080", "E08080", "F4908080", "E282", "FF", "F0808080")


def validate_encoding(spark, sf_dir):
    """The documents as bytes, with wrong ones put in the middle of some: where each first goes wrong, and why."""
    data, n = F.col("text").cast("binary"), len(_BAD_BYTES)
    half = (F.octet_length("text") / 2).cast("int")
    wrong = F.unhex(F.get(F.array(*map(F.lit, _BAD_BYTES)), (F.floor(F.col("doc_id") / 3) % n).cast("int")))
    spoilt = F.when(F.col("doc_id") % 3 == 1, F.concat(F.substr(data, F.lit(1), half), wrong, F.substr(data, half + 1))).otherwise(data)
    return _documents(spark, sf_dir).select("doc_id", validate.encoding_error(spoilt).alias("e")).where("e is not null").select("doc_id", "e.place", "e.reason")


def validate_overall(spark, sf_dir):
    rows = _json_lines(spark, sf_dir)
    return validate.overall(validate.validate_rows(interactions(spark, sf_dir)), {k: validate.validate_json(rows, k, k) for k in validate.JSON_RULES})


def _round_trip(kind: str):
    def query(spark, sf_dir):
        rows = interactions(spark, sf_dir)
        path = f"{scratch(spark)}/{kind}-{uuid.uuid4().hex}.{kind}"
        io.write_table(rows, path)
        return io.read_table(spark, path).select(*rows.columns)

    query.__name__ = f"source_{kind}"
    return query


def source_splits(spark, sf_dir):
    """Written by split as JSON lines, and read back as named splits."""
    path = f"{scratch(spark)}/splits-{uuid.uuid4().hex}"
    chats = _formatted(spark, sf_dir).select("row_id", "messages", "metadata")
    split.split(chats).select("messages", "metadata", "split").write.partitionBy("split").json(path)
    back = io.read_splits(spark, {n: f"{path}/split={n}" for n in ("train", "validation")}).union(io.read_test(spark, f"{path}/split=test").withColumn("split", F.lit("test")))
    return back.groupBy("split").agg(F.count("*").alias("n"), F.sum(F.length(F.get("messages", 1)["content"])).alias("chars"))


def eda_kde(spark, sf_dir):
    return profile.density(interactions(spark, sf_dir))


def split_siblings(spark, sf_dir):
    """Turns, those of a conversation together."""
    return split.split_groups(_documents(spark, sf_dir, "conversations"), "conv_id").select("conv_id", "turn", "split")


def source_versions(spark, sf_dir):
    """The version of two tables by their content, rows dealt in another order."""
    tables = {"conversations": _documents(spark, sf_dir, "conversations").repartition(7), "interactions": interactions(spark, sf_dir)}
    return reduce(DataFrame.union, [io.digest(df).select(F.lit(n).alias("name"), "n_rows", "version") for n, df in tables.items()])


def report_metrics(spark, sf_dir):
    return report.flat(clean.removal_report(_raw_docs(spark, sf_dir)))


def queries() -> dict:
    own = (
        eda_profile, eda_length_stats, eda_length_histogram, eda_category_dist, eda_intent_top20, eda_dist_grouping_sets, clean_text_docs, clean_pages_unescape, clean_nfkc,
        clean_dedupe_first, clean_removal_report, quality_filter, quality_report, enrich_distributions, augment_short_form, augment_long_form, augment_paraphrase, augment_typos,
        augment_all_dist, format_alpaca, format_chatml, format_messages, render_template, render_prompt, validate_rows, validate_formats, token_estimates, token_stats, split_assign,
        split_sizes, split_intent_dist, sample_k, report_progression, report_metrics, report_headline, eda_distinct,
        validate_json_formats, validate_overall, validate_encoding, eda_kde, render_files, split_siblings, source_versions, _round_trip("csv"), _round_trip("jsonl"), _round_trip("json"), source_splits,
    )
    out = {f.__name__: f for f in own}
    out |= {f"score_{c.removesuffix('_score')}": _score_query(c) for c in (*score.WEIGHTS, "quality_score")}
    return out | {f"enrich_{c}": _label_query(c) for c in enrich.LABELS}


# --- SQL -------------------------------------------------------------------------------------------------------------

_SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
_LINE_SPACE = r"[\t\r\f\x0b\x1c-\x1f\x{85}\p{Z}]"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(xs) -> str:
    return "[" + ", ".join(map(_q, xs)) + "]"


def _re(c: str, pattern: str, to: str) -> str:
    return f"regexp_replace({c}, {_q(pattern)}, {_q(to)}, 'g')"


def _wc(c: str) -> str:
    return f"len(regexp_extract_all({c}, '[^{_SPACE}]+'))"


def _has(c: str, terms) -> str:
    return "(" + " OR ".join(f"contains({c}, {_q(t)})" for t in terms) + ")"


def _pick(salt: str, k) -> str:
    return f"(CAST(concat('0x', substr(md5(concat_ws('|', row_id, {salt})), 1, 8)) AS BIGINT) % {k})"


def _one(options, number: str) -> str:
    return f"[{', '.join(options)}][{number} + 1]"


def _map(entries: dict) -> str:
    return "MAP {" + ", ".join(f"{_q(str(k))}: {_q(v)}" for k, v in entries.items()) + "}"


def _unescaped(c: str) -> str:
    """References resolved token by token, from the same public tables."""
    closed = {f"{n};": t for names in unicode.closed_names().values() for n, t in names.items()}
    opened, odd = unicode.open_names(), unicode.odd_numbers()
    number = lambda n: f"CASE WHEN {n} IS NULL OR {n} BETWEEN 55296 AND 57343 OR {n} > 1114111 THEN {_q(unicode.LOST)} WHEN ({_map(odd)})[CAST({n} AS VARCHAR)] IS NOT NULL THEN ({_map(odd)})[CAST({n} AS VARCHAR)] ELSE chr(CAST({n} AS INTEGER)) END"
    decimal = "TRY_CAST(regexp_extract(t, '[0-9]+') AS BIGINT)"
    hexadecimal = "TRY_CAST(concat('0x', regexp_extract(t, '[xX]0*([0-9a-fA-F]*)', 1)) AS BIGINT)"
    zero = "WHEN regexp_matches(t, '^&#[xX]0+;?$') THEN " + _q(unicode.LOST)
    start = f"regexp_extract(t, '^&({'|'.join(opened)})', 1)"
    token = f"""CASE WHEN NOT starts_with(t, '&') OR t = '&' THEN t WHEN regexp_matches(t, '^&#[0-9]') THEN {number(decimal)} {zero} WHEN regexp_matches(t, '^&#[xX][0-9a-fA-F]') THEN {number(hexadecimal)}
  WHEN ({_map(closed)})[substr(t, 2)] IS NOT NULL THEN ({_map(closed)})[substr(t, 2)]
  WHEN {start} <> '' THEN concat(({_map(opened)})[{start}], substr(t, length({start}) + 2)) ELSE t END"""
    return f"CASE WHEN contains({c}, '&') THEN array_to_string(list_transform(regexp_extract_all({c}, {_q(unicode.REFERENCE + '|[^&]+|&')}), lambda t: {token}), '') ELSE {c} END"


def _nfkc(c: str) -> str:
    """Compatibility characters replaced by their parts, then the canonical form. Only characters of the
    other forms are taken apart."""
    whole = {ch: d for form in _FORMS.values() for ch in form if (d := unicodedata.normalize("NFKD", ch)) != ch}
    parts = f"array_to_string(list_transform(regexp_extract_all({c}, '[{''.join(whole)}]|[^{''.join(whole)}]+'), lambda t: coalesce(({_map(whole)})[t], t)), '')"
    return f"nfc_normalize({parts})"


def _clean(c: str) -> str:
    c = f"translate({_unescaped(f'coalesce({c}, {_q(str())})')}, '‘’‚‛“”„‟‹›–—', {_q(chr(39) * 4 + chr(34) * 4 + '<>--')})"
    for a, b in ((r"\?+", "?"), ("!+", "!"), (",+", ","), (r"\.{4,}", "..."), (r"[ \t]+", " "), (rf"{_LINE_SPACE}*\n{_LINE_SPACE}*", "\n"), (r"\n{3,}", "\n\n"), (rf"^[{_SPACE}]+|[{_SPACE}]+\z", "")):
        c = _re(c, a, b)
    return c


def _capital(c: str) -> str:
    return rf"CASE WHEN regexp_matches({c}, '^\p{{Ll}}') THEN concat(upper(substr({c}, 1, 1)), substr({c}, 2)) ELSE {c} END"


def _sentences(c: str) -> str:
    for x in "abcdefghijklmnopqrstuvwxyz":
        c = _re(c, rf"([.!?]\s+){x}", rf"\1{x.upper()}")
    return c


_BASE = f"base AS ({INTERACTIONS_SQL})"
_DIRTY_BASE = f"base AS ({_DIRTY.format(base=INTERACTIONS_SQL)})"
_CLEANED = f"""c0 AS (SELECT *, {_clean('instruction')} AS i, {_clean('response')} AS r FROM base),
c1 AS (SELECT *, {_capital('i')} AS ci, {_capital('r')} AS cr FROM c0),
c2 AS (SELECT * REPLACE (ci AS instruction, {_sentences('cr')} AS response), (instruction IS NULL OR response IS NULL) AS missing FROM c1),
c3 AS (SELECT *, CASE WHEN missing THEN 'null' WHEN length(instruction) = 0 OR length(response) = 0 THEN 'empty' END AS early FROM c2),
c4 AS (SELECT *, row_number() OVER (PARTITION BY instruction, response, early IS NULL ORDER BY row_id) AS nth FROM c3),
reasons AS (SELECT *, CASE WHEN early IS NOT NULL THEN early WHEN nth > 1 THEN 'duplicate'
  WHEN instruction = response OR NOT regexp_matches(instruction, '\\p{{L}}') OR NOT regexp_matches(response, '\\p{{L}}') THEN 'malformed' ELSE 'kept' END AS reason FROM c4)"""


def _steps(*steps) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {p}" for c, p in steps) + " ELSE 0 END"


def _score_ctes(source: str) -> str:
    both = lambda s: f"(contains(instruction, {_q(s)}) OR contains(response, {_q(s)}))"
    il, rl = "length(instruction)", "length(response)"
    return f"""s0 AS (SELECT *, coalesce(flags, 'nan') AS f, {_wc('response')} AS n, len(regexp_extract_all(response, '[^.!?{_SPACE}][^.!?]*')) AS s,
  list_distinct(regexp_extract_all(lower(response), '[\\p{{L}}\\p{{N}}_]+')) AS rw,
  list_filter(list_distinct(regexp_extract_all(lower(instruction), '[\\p{{L}}\\p{{N}}_]+')), lambda x: NOT list_contains({_list(L.STOP_WORDS)}, x)) AS iw,
  list_filter(string_split(replace(lower(coalesce(intent, 'nan')), '_', ' '), ' '), lambda x: x <> '') AS tw,
  length(regexp_replace(response, '[{_SPACE}]', '', 'g')) AS letters FROM {source}),
s1 AS (SELECT *,
  CAST(greatest(1, 10 - {_steps(("contains(f, 'Z')", 2))} - {_steps((both('  '), 2))} - {_steps((both(',,'), 1))} - {_steps((both('??'), 0.5))} - {_steps((both('!!'), 0.5))}) AS DOUBLE) AS grammar_score,
  CAST(greatest(1, 10 - {_steps((f"NOT (right(response, 1) IN ('.', '!', '?', {_q(chr(34))}, {_q(chr(39))}))", 3))} - {_steps(('n < 10', 4), ('n < 20', 2))} - {_steps(('NOT ' + _has('lower(response)', L.HELP_MARKERS), 1))}) AS DOUBLE) AS completeness_score,
  CAST(greatest(1, 10 - {_steps((f'{il} < 10', 4), (f'{il} < 20', 2), (f'{il} > 300', 1))} - {_steps((f'{rl} < 50', 4), (f'{rl} < 100', 2), (f'{rl} > 2000', 2), (f'{rl} > 1500', 1))}) AS DOUBLE) AS length_score,
  CAST(greatest(1, 10 - CASE WHEN len(iw) = 0 THEN 0 ELSE {_steps(('len(list_intersect(iw, rw)) / len(iw) < 0.1', 4), ('len(list_intersect(iw, rw)) / len(iw) < 0.25', 2), ('len(list_intersect(iw, rw)) / len(iw) < 0.5', 0.5))} END
    - {_steps(('len(tw) > 0 AND NOT list_has_any(tw, rw)', 2))}) AS DOUBLE) AS relevance_score,
  CAST(CASE WHEN n = 0 OR s = 0 THEN 1 ELSE greatest(1, 10 - {_steps(('n / s > 30', 2), ('n / s > 20', 1))} - {_steps(('letters / n > 7', 2), ('letters / n > 6', 1))}) END AS DOUBLE) AS readability_score FROM s0),
scored AS (SELECT *, round(CAST(0.20 AS DOUBLE) * grammar_score + CAST(0.25 AS DOUBLE) * completeness_score + CAST(0.15 AS DOUBLE) * length_score + CAST(0.20 AS DOUBLE) * relevance_score
  + CAST(0.20 AS DOUBLE) * readability_score, 2) AS quality_score FROM s1)"""


def _hits(c: str, terms) -> str:
    return "(" + " + ".join(f"CAST(contains({c}, {_q(t)}) AS INT)" for t in terms) + ")"


_ENRICHED = f"""e0 AS (SELECT *, lower(instruction) AS q, lower(coalesce(intent, 'nan')) AS li, lower(coalesce(category, 'nan')) AS lc, length(coalesce(flags, 'nan')) AS fl FROM base),
e1 AS (SELECT *, {_wc('instruction')} AS n, {_hits('q', L.NEGATIVE)} + CASE WHEN contains(q, '?') THEN 0.2 ELSE 0 END AS neg0, {_hits('q', L.POSITIVE)} AS pos FROM e0),
e2 AS (SELECT *, neg0 + CASE WHEN contains(q, '!') AND neg0 > 0 THEN 1 ELSE 0 END AS neg FROM e1),
e3 AS (SELECT *, CASE WHEN neg > pos THEN 'negative' WHEN pos > neg THEN 'positive' ELSE 'neutral' END AS sentiment,
  CASE WHEN {_has('li', L.HIGH_INTENTS)} OR contains(lc, 'security') OR ({_has('q', L.URGENT)} AND contains(q, 'help')) THEN 'high'
    WHEN {_has('li', L.MEDIUM_INTENTS)} OR {_has('lc', ('billing', 'account'))} OR {_has('q', ('problem', 'issue'))} THEN 'medium' ELSE 'low' END AS urgency FROM e2),
enriched AS (SELECT *, {_has('q', L.ESCALATION)} OR (urgency = 'high' AND sentiment = 'negative') OR {_has('q', L.ILLEGAL)} AS escalation,
  CASE WHEN (n > 20 AND fl >= 4) OR (n > 15 AND {_has('q', L.CONDITIONS)}) THEN 'high' WHEN n < 8 AND fl <= 2 THEN 'low' ELSE 'medium' END AS complexity FROM e3)"""


def _render(parts, tail: str = "") -> str:
    return "concat(" + ", ".join(f"'<|im_start|>{role}\n', {c}, '<|im_end|>\n'" for role, c in parts) + (f", {_q(tail)}" if tail else "") + ")"


_SYSTEM = ("system", _q(L.SYSTEM_PROMPT))
_TURNS = (_SYSTEM, ("user", "instruction"), ("assistant", "response"))
_MESSAGES = "[" + ", ".join(f"{{'role': '{r}', 'content': {c}}}" for r, c in _TURNS) + "]"
_EST = lambda c: f"coalesce(CAST(floor({_wc(c)} * CAST(1.3 AS DOUBLE)) AS BIGINT) + 4, 0)"
_TOKENS = f"tok AS (SELECT row_id, {_EST(_render(_TURNS))} AS full_tokens, {_EST('instruction')} AS query_tokens, {_EST('response')} AS response_tokens FROM base)"
_SPLIT = """ranked AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', row_id, '42')), row_id) - 1 AS k, count(*) OVER () AS n FROM base),
parts AS (SELECT *, CASE WHEN k < floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' WHEN k < floor(n * CAST(0.8 AS DOUBLE)) + floor(n * CAST(0.1 AS DOUBLE)) THEN 'validation' ELSE 'test' END AS split FROM ranked)"""
_LOWER_FIRST = "concat(lower(substr(instruction, 1, 1)), substr(instruction, 2))"


def _short_sql() -> str:
    intent = "replace(coalesce(intent, 'nan'), '_', ' ')"
    forms = ["concat(" + _q(a) + f", {intent}, " + _q(b) + ")" for a, b in (t.split("{}") for t in L.SHORT_TEMPLATES)]
    marks = r"regexp_extract_all(instruction, '\{\{.*?\}\}')"
    return f"""WITH {_BASE}, m AS (SELECT row_id, concat({_one(forms, _pick("'short'", 4))}, CASE WHEN len({marks}) > 0 THEN concat(' ', array_to_string({marks}, ' ')) ELSE '' END) AS t FROM base)
SELECT row_id, concat(upper(substr(t, 1, 1)), substr(t, 2)) AS instruction FROM m"""


def _paraphrase_sql() -> str:
    c = "instruction"
    for word, by in L.SYNONYMS:
        c = f"regexp_replace({c}, '\\b{word}\\b', '{by}', 'gi')"
    new = _one([*map(_q, L.NEW_OPENINGS)], _pick("'opening'", 5))
    starts = " ".join(f"WHEN starts_with(response, {_q(o)}) THEN concat({new}, substr(response, {len(o) + 1}))" for o in L.OPENINGS)
    return f"WITH {_BASE}, p AS (SELECT *, {c} AS c FROM base) SELECT row_id, CASE WHEN c = instruction THEN concat('Please, ', {_LOWER_FIRST}) ELSE c END AS instruction, CASE {starts} ELSE response END AS response FROM p"


def _typos_sql() -> str:
    keys = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in L.ADJACENT_KEYS.items()) + "}"
    draw = lambda kind, i, k: _pick(f"concat_ws('|', '{kind}', j - 1, {i})", k)
    drawn = lambda i: f"({draw('typo', i, 10000)} < 800)"
    swap = lambda i: f"({drawn(i)} AND {draw('kind', i, 4)} = 2)"
    real = lambda i: f"({swap(i)} AND NOT ({i} > 0 AND {swap(f'({i} - 1)')}))"
    near = f"({keys})[lower(c)]"
    key = f"substr({near}, {draw('key', '(i - 1)', f'length({near})')} + 1, 1)"
    return f"""WITH {_BASE} SELECT row_id, CASE WHEN length(instruction) < 5 THEN instruction ELSE array_to_string(list_filter(list_transform(
  regexp_extract_all(instruction, '[^{_SPACE}]+'), lambda w, j: CASE WHEN regexp_matches(w, '[{{}}]') THEN w ELSE array_to_string(list_transform(string_split(w, ''), lambda c, i:
    CASE WHEN i > 1 AND {real('(i - 2)')} THEN '' WHEN NOT {drawn('(i - 1)')} THEN c ELSE
      CASE {draw('kind', '(i - 1)', 4)} WHEN 0 THEN CASE WHEN {near} IS NULL THEN c WHEN c = lower(c) THEN {key} ELSE upper({key}) END WHEN 1 THEN concat(c, c) WHEN 3 THEN ''
        ELSE CASE WHEN {real('(i - 1)')} AND i < len(string_split(w, '')) THEN concat(string_split(w, '')[i + 1], c) ELSE c END END END), '') END), lambda x: x <> ''), ' ') END AS instruction FROM base"""


def _dist(source: str, columns, ctes: str) -> str:
    union = " UNION ALL ".join(f"SELECT '{c}' AS field, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}" for c in columns)
    return f"WITH {ctes}, d AS ({union}) SELECT field, value, n, round(n * CAST(100 AS DOUBLE) / sum(n) OVER (PARTITION BY field), 2) AS percent FROM d"


_REMOVAL = """SELECT count(*) AS initial_rows, count(*) FILTER (reason = 'null') AS null_removed, count(*) FILTER (reason = 'empty') AS empty_removed,
  count(*) FILTER (reason = 'duplicate') AS duplicate_removed, count(*) FILTER (reason = 'malformed') AS malformed_removed, count(*) FILTER (reason = 'kept') AS final_rows,
  count(*) FILTER (reason <> 'kept') AS total_removed FROM reasons"""


def _json_texts() -> str:
    """The three JSON texts of _json_lines."""
    records = _list(_RECORDS)
    spoilt = lambda c: f"CASE WHEN row_id % 4 = 0 THEN ({records})[CAST(floor(row_id / 4) AS BIGINT) % {len(_RECORDS)} + 1] WHEN row_id % 9 = 5 THEN substr({c}, 1, CAST(floor(length({c}) / 2) AS INTEGER)) ELSE {c} END"
    alpaca = "CAST(to_json({'instruction': instruction, 'input': '', 'output': response}) AS VARCHAR)"
    chatml = "CAST(to_json([{'role': 'user', 'content': instruction}, {'role': 'assistant', 'content': response}]) AS VARCHAR)"
    messages = f"""CAST(to_json({{'messages': {_MESSAGES}, 'metadata': {{'intent': intent, 'category': category, 'sentiment': sentiment, 'urgency': urgency, 'escalation': escalation, 'complexity': complexity}}}}) AS VARCHAR)"""
    return f"t AS (SELECT row_id, {spoilt(alpaca)} AS alpaca, {spoilt(chatml)} AS chatml, {spoilt(messages)} AS messages FROM enriched)"


def _json_checks() -> str:
    """By DuckDB's JSON functions: the first rule that each text breaks, and the message's place."""
    lacks = lambda c, k: f"json_extract({c}, '$.{k}') IS NULL"
    other = lambda c, kind: f"coalesce(json_type({c}), '') <> '{kind}'"

    def first(elements: str, *rules: tuple[str, str]) -> str:
        found = "CASE " + " ".join(f"WHEN {test} THEN '{rule}'" for rule, test in rules) + " END"
        return f"list_filter(list_transform({elements}, lambda m, i: CASE WHEN ({found}) IS NOT NULL THEN concat({found}, ':', i - 1) END), lambda e: e IS NOT NULL)[1]"

    turns = first("json_extract(c, '$[*]')", ("object", other("m", "OBJECT")), ("role", "coalesce(json_extract_string(m, '$.role'), '') <> CASE WHEN i = 1 THEN 'user' ELSE 'assistant' END"), ("content", lacks("m", "content")))
    said = first("json_extract(m0, '$.messages[*]')", ("object", other("m", "OBJECT")), ("role", lacks("m", "role")), ("content", lacks("m", "content")))
    return f"""j AS (SELECT row_id, CASE WHEN json_valid(alpaca) THEN alpaca END AS a, CASE WHEN json_valid(chatml) THEN chatml END AS c, CASE WHEN json_valid(messages) THEN messages END AS m0 FROM t),
e AS (SELECT row_id,
  CASE WHEN a IS NULL THEN 'json' WHEN {other('a', 'OBJECT')} THEN 'object' WHEN {lacks('a', 'instruction')} THEN 'instruction' WHEN {lacks('a', 'input')} THEN 'input' WHEN {lacks('a', 'output')} THEN 'output' END AS alpaca,
  CASE WHEN c IS NULL THEN 'json' WHEN {other('c', 'ARRAY')} THEN 'array' WHEN json_array_length(c) <> 2 THEN 'size' ELSE {turns} END AS chatml,
  CASE WHEN m0 IS NULL THEN 'json' WHEN {other('m0', 'OBJECT')} THEN 'object' WHEN {lacks('m0', 'messages')} THEN 'messages' WHEN coalesce(json_type(json_extract(m0, '$.messages')), '') <> 'ARRAY' THEN 'array'
    WHEN json_array_length(json_extract(m0, '$.messages')) < 2 THEN 'size' ELSE {said} END AS messages FROM j)"""


def _encoding_sql() -> str:
    """Over pairs of hexadecimal digits, a space behind each."""
    pairs = f"regexp_replace(CASE WHEN doc_id % 3 = 1 THEN concat(substr(h, 1, 2 * half), ({_list(_BAD_BYTES)})[CAST(floor(doc_id / 3) AS BIGINT) % {len(_BAD_BYTES)} + 1], substr(h, 2 * half + 1)) ELSE h END, '(..)', '\\1 ', 'g')"
    blank = pairs
    for n, pattern in ((4, "F0 [9AB]. [89AB]. [89AB]. |F[123] [89AB]. [89AB]. [89AB]. |F4 8. [89AB]. [89AB]. "), (3, "E0 [AB]. [89AB]. |E[1-9A-CEF] [89AB]. [89AB]. |ED [89]. [89AB]. "), (2, "(C[2-9A-F]|D.) [89AB]. ")):
        blank = f"regexp_replace({blank}, '{pattern}', '{'xx ' * n}', 'g')"
    return f"""WITH b AS (SELECT doc_id, hex(encode(text)) AS h, CAST(floor(octet_length(encode(text)) / 2) AS INTEGER) AS half FROM documents),
r AS (SELECT doc_id, {pairs} AS p, {blank} AS x FROM b),
f AS (SELECT doc_id, p, length(regexp_extract(x, '^(?:[0-7x]. )*')) // 3 AS place, length(x) // 3 AS n FROM r),
w AS (SELECT doc_id, place, substr(p, place * 3 + 1, 2) AS byte, substr(p, place * 3 + 4, 1) AS after FROM f WHERE place < n)
SELECT doc_id, CAST(place AS INTEGER) AS place, CASE WHEN byte < 'C0' THEN 'stray' WHEN byte < 'C2' OR byte > 'F4' THEN 'impossible' WHEN byte = 'ED' AND after IN ('A', 'B') THEN 'surrogate'
  WHEN (byte = 'E0' AND after IN ('8', '9')) OR (byte = 'F0' AND after = '8') THEN 'overlong' WHEN byte = 'F4' AND after IN ('9', 'A', 'B') THEN 'beyond' ELSE 'truncated' END AS reason FROM w"""


def _kde_sql(points: int = 200, cells: int = 1024) -> str:
    return f"""WITH {_BASE}, v AS (SELECT 'instruction' AS field, CAST({_wc('instruction')} AS DOUBLE) AS v FROM base WHERE instruction IS NOT NULL UNION ALL SELECT 'response', CAST({_wc('response')} AS DOUBLE) FROM base WHERE response IS NOT NULL),
m AS (SELECT field, min(v) AS low, max(v) AS high, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS width FROM v GROUP BY field HAVING max(v) > min(v)),
p AS (SELECT field, (v - low) / (high - low) * {cells} AS place FROM v JOIN m USING (field)), c AS (SELECT field, place, least(floor(place), {cells - 1}) AS cell FROM p),
w AS (SELECT field, cell, sum(share) AS share FROM (SELECT field, cell, 1 - (place - cell) AS share FROM c UNION ALL SELECT field, cell + 1, place - cell FROM c) x GROUP BY 1, 2),
g AS (SELECT *, low + point * (high - low) / {points - 1} AS x FROM (SELECT *, unnest(range(0, {points})) AS point FROM m) y),
s AS (SELECT field, point, max(x) AS x, max(n) AS n, sum(share * exp(-0.5 * pow((x - (low + cell * (high - low) / {cells})) / width, 2))) / (max(width) * sqrt(2 * pi())) AS e FROM w JOIN g USING (field) GROUP BY 1, 2)
SELECT field, CAST(point AS BIGINT) AS point, round(x, 6) AS x, round(e / n, 9) AS density, round(e, 6) AS expected FROM s"""


_SIBLINGS = """WITH g AS (SELECT md5(concat('=', conv_id, '|42')) AS h, count(*) AS n FROM conversations GROUP BY conv_id),
p AS (SELECT h, CAST(sum(n) OVER (ORDER BY h) AS BIGINT) AS stop, n, CAST(sum(n) OVER () AS BIGINT) AS total FROM g),
l AS (SELECT *, stop - n AS start, floor(total * CAST(0.8 AS DOUBLE)) AS a, floor(total * CAST(0.8 AS DOUBLE)) + floor(total * CAST(0.1 AS DOUBLE)) AS b FROM p),
s AS (SELECT h, least(stop, a) - start AS x, least(stop, b) - greatest(start, a) AS y, stop - greatest(start, b) AS z FROM l)
SELECT conv_id, turn, CASE WHEN x >= y AND x >= z THEN 'train' WHEN y >= z THEN 'validation' ELSE 'test' END AS split FROM conversations JOIN s ON s.h = md5(concat('=', conv_id, '|42'))"""


def _version(name: str, source: str, columns) -> str:
    cells = ", '|', ".join(f"CASE WHEN {c} IS NULL THEN '{c}~' ELSE concat('{c}=', length(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)) END" for c in sorted(columns))
    part = lambda at: f"CAST(sum(CAST(concat('0x', substr(h, {at}, 15)) AS BIGINT)) AS VARCHAR)"
    return f"SELECT '{name}' AS name, count(*) AS n_rows, md5(concat('{','.join(sorted(columns))}', '|', count(*), '|', {part(1)}, '|', {part(17)})) AS version FROM (SELECT md5(concat({cells})) AS h FROM {source}) x"


def oracle_sql() -> dict[str, str]:
    cols = ("row_id", "instruction", "response", "category", "intent", "flags")
    sizes = {"instruction_chars": "length(instruction)", "instruction_words": _wc("instruction"), "response_chars": "length(response)", "response_words": _wc("response")}
    stats = ", ".join(f"round(avg({v}), 6) AS avg_{k}, max({v}) AS max_{k}, min({v}) AS min_{k}, CAST(median({v}) AS DOUBLE) AS median_{k}" for k, v in sizes.items())
    token_columns = ("full_tokens", "query_tokens", "response_tokens")
    na = ", ".join(map(_q, L.NA_TOKENS))
    token_stats = ", ".join(f"round(avg({c}), 6) AS avg_{c}, max({c}) AS max_{c}, min({c}) AS min_{c}" for c in token_columns)
    blank = lambda c: f"regexp_matches({c}, '^[{_SPACE}]*\\z')"
    bad_text = "(instruction IS NULL OR response IS NULL)"
    other = "text"
    for plain, form in _FORMS.items():
        other = f"replace({other}, {_q(plain)}, {_q(form)})"
    out = {
        "eda_profile": f"""WITH {_BASE} SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns, {", ".join(f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in cols)},
  count(*) FILTER ({" OR ".join(f"{c} IS NULL" for c in cols)}) AS rows_with_null, count(*) FILTER (length(coalesce(instruction, '')) < 10) AS short_instruction,
  count(*) FILTER (length(coalesce(response, '')) < 20) AS short_response, count(*) FILTER (regexp_matches(instruction, '\\{{\\{{.*?\\}}\\}}')) AS placeholder_instruction,
  count(*) FILTER (regexp_matches(response, '\\{{\\{{.*?\\}}\\}}')) AS placeholder_response, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM base)) AS duplicate_rows FROM base""",
        "eda_length_stats": f"WITH {_BASE} SELECT {stats} FROM base",
        "eda_length_histogram": f"""WITH {_BASE}, v AS (SELECT 'instruction' AS field, {sizes["instruction_words"]} AS v FROM base UNION ALL SELECT 'response', {sizes["response_words"]} FROM base),
m AS (SELECT field, min(v) AS low, max(v) AS high FROM v GROUP BY field)
SELECT field, CAST(CASE WHEN high = low THEN 0 ELSE least(floor((v - low) * 30 / (high - low)), 29) END AS BIGINT) AS bin, count(*) AS n FROM v JOIN m USING (field) GROUP BY 1, 2""",
        "eda_category_dist": f"WITH {_BASE} SELECT category, count(*) AS n FROM base WHERE category IS NOT NULL GROUP BY category",
        "eda_intent_top20": f"WITH {_BASE} SELECT intent, count(*) AS n FROM base WHERE intent IS NOT NULL GROUP BY intent ORDER BY n DESC, intent LIMIT 20",
        "eda_dist_grouping_sets": _dist("base", ("category", "intent"), _BASE),
        "clean_text_docs": f"WITH c AS (SELECT doc_id, {_clean('text')} AS t FROM documents), k AS (SELECT doc_id, {_capital('t')} AS t FROM c) SELECT doc_id, t AS as_instruction, {_sentences('t')} AS as_response FROM k",
        "clean_pages_unescape": f"SELECT page_id, {_unescaped('html')} AS html FROM pages",
        "clean_nfkc": f"WITH f AS (SELECT doc_id, {other} AS t FROM documents) SELECT doc_id, {_nfkc('t')} AS text FROM f",
        "clean_dedupe_first": f"WITH {_DIRTY_BASE}, {_CLEANED} SELECT row_id, instruction, response FROM reasons WHERE reason = 'kept'",
        "clean_removal_report": f"WITH {_DIRTY_BASE}, {_CLEANED} {_REMOVAL}",
        "quality_filter": f"WITH {_BASE}, {_score_ctes('base')} SELECT row_id, quality_score FROM scored WHERE quality_score >= 7",
        "quality_report": f"""WITH {_BASE}, {_score_ctes('base')} SELECT count(*) AS n_rows, count(*) FILTER (quality_score >= 7) AS passed, count(*) FILTER (quality_score < 7) AS filtered,
  round(avg(quality_score), 6) AS mean_quality, min(quality_score) AS min_quality, max(quality_score) AS max_quality, {", ".join(f"round(avg({c}), 6) AS mean_{c}" for c in score.WEIGHTS)} FROM scored""",
        "enrich_distributions": _dist("enriched", enrich.LABELS, f"{_BASE}, {_ENRICHED}"),
        "augment_short_form": _short_sql(),
        "augment_long_form": f"""WITH {_BASE} SELECT row_id, concat({_one([*map(_q, L.LONG_PREFIXES)], _pick("'prefix'", 4))}, {_LOWER_FIRST}, {_one([*map(_q, L.LONG_SUFFIXES)], _pick("'suffix'", 4))}) AS instruction FROM base""",
        "augment_paraphrase": _paraphrase_sql(),
        "augment_typos": _typos_sql(),
        "augment_all_dist": f"""WITH {_BASE}, p AS (SELECT row_number() OVER (ORDER BY row_id) - 1 AS k FROM base),
v AS (SELECT 'original' AS t FROM p UNION ALL SELECT 'typos' FROM p UNION ALL SELECT CASE WHEN k % 2 = 0 THEN 'short_form' ELSE 'long_form' END FROM p UNION ALL SELECT 'paraphrase_rewrite' FROM p)
SELECT t AS augmentation_type, t <> 'original' AS is_augmented, count(*) AS n FROM v GROUP BY t""",
        "format_alpaca": f"WITH {_BASE} SELECT row_id, CAST(to_json({{'instruction': instruction, 'input': '', 'output': response}}) AS VARCHAR) AS json FROM base",
        "format_chatml": f"WITH {_BASE} SELECT row_id, CAST(to_json([{{'role': 'user', 'content': instruction}}, {{'role': 'assistant', 'content': response}}]) AS VARCHAR) AS json FROM base",
        "format_messages": f"""WITH {_BASE}, {_ENRICHED} SELECT row_id, CAST(to_json({{'messages': {_MESSAGES}, 'metadata': {{'intent': intent, 'category': category, 'sentiment': sentiment,
  'urgency': urgency, 'escalation': escalation, 'complexity': complexity}}}}) AS VARCHAR) AS json FROM enriched""",
        "render_template": f"WITH {_BASE} SELECT row_id, {_render(_TURNS)} AS text FROM base",
        "render_prompt": f"WITH {_BASE} SELECT row_id, {_render(_TURNS[:2], '<|im_start|>assistant' + chr(10))} AS text FROM base",
        "validate_rows": f"""WITH {_DIRTY_BASE}, p AS (SELECT *, CASE WHEN {bad_text} THEN 'missing' WHEN {blank('instruction')} OR {blank('response')} THEN 'empty' END AS problem FROM base)
SELECT count(*) AS n_rows, count(*) FILTER (problem = 'missing') AS missing_fields, count(*) FILTER (problem = 'empty') AS empty_fields, CAST(0 AS BIGINT) AS encoding_errors,
  count(*) FILTER (problem IS NULL AND length(instruction) > 150) AS long_queries, count(*) FILTER (problem IS NULL AND length(response) > 1000) AS long_responses, count(problem) = 0 AS is_valid FROM p""",
        "validate_formats": f"WITH {_DIRTY_BASE} SELECT count(*) AS n_rows, count(*) FILTER {(bad := f'({bad_text})')} AS alpaca_errors, count(*) FILTER {bad} AS chatml_errors, count(*) FILTER {bad} AS messages_errors, count(*) FILTER {bad} = 0 AS is_valid FROM base",
        "token_estimates": f"WITH {_BASE}, {_TOKENS} SELECT * FROM tok",
        "token_stats": f"""WITH {_BASE}, {_TOKENS} SELECT count(*) AS n_rows, {token_stats}, {", ".join(f"round(quantile_cont(full_tokens, {p}), 6) AS p{n}" for n, p in ((50, 0.5), (90, 0.9), (95, 0.95), (99, 0.99)))},
  CAST(greatest(ceil(quantile_cont(full_tokens, 0.99) / 128) * 128, 512) AS BIGINT) AS recommended_length FROM tok""",
        "split_assign": f"WITH {_BASE}, {_SPLIT} SELECT row_id, split FROM parts",
        "split_sizes": f"WITH {_BASE}, {_SPLIT} SELECT split, count(*) AS n FROM parts GROUP BY split",
        "split_intent_dist": f"WITH {_BASE}, {_SPLIT} SELECT split, coalesce(intent, 'unknown') AS intent, count(*) AS n FROM parts GROUP BY 1, 2",
        "sample_k": f"WITH {_BASE} SELECT row_id, instruction FROM base ORDER BY md5(concat_ws('|', row_id, '42')), row_id LIMIT 20",
        "report_progression": f"""WITH {_DIRTY_BASE}, {_CLEANED}, kept AS (SELECT row_id, instruction, response, category, intent, flags FROM reasons WHERE reason = 'kept'), {_score_ctes('kept')},
k AS (SELECT (SELECT count(*) FROM base) AS a, (SELECT count(*) FROM kept) AS b, (SELECT count(*) FROM scored WHERE quality_score >= 7) AS c)
SELECT 0 AS stage_no, 'raw' AS stage, a AS n_rows, CAST(0 AS BIGINT) AS delta FROM k UNION ALL SELECT 1, 'cleaned', b, b - a FROM k UNION ALL SELECT 2, 'filtered', c, c - b FROM k UNION ALL SELECT 3, 'augmented', 4 * c, 3 * c FROM k""",
        "report_headline": f"""WITH {_DIRTY_BASE}, {_CLEANED}, kept AS (SELECT row_id, instruction, response, category, intent, flags FROM reasons WHERE reason = 'kept'), {_score_ctes('kept')},
k AS (SELECT (SELECT count(*) FROM base) AS a, (SELECT count(*) FROM kept) AS b, (SELECT count(*) FROM scored WHERE quality_score >= 7) AS c),
s AS (SELECT *, CAST(floor(4 * c * CAST(0.8 AS DOUBLE)) AS BIGINT) AS train, CAST(floor(4 * c * CAST(0.1 AS DOUBLE)) AS BIGINT) AS val FROM k)
SELECT a AS raw_records, b AS cleaned_records, c AS quality_passed_records, 4 * c AS augmented_records, a - b AS removed_cleaning_count, b - c AS removed_quality_count, 3 * c AS augmented_added_count,
  train AS train_records, val AS val_records, 4 * c - train - val AS test_records, (SELECT round(avg(quality_score), 6) FROM scored) AS average_quality_score FROM s""",
        "eda_distinct": f"WITH {_BASE} SELECT count(DISTINCT category) AS distinct_category, count(DISTINCT intent) AS distinct_intent FROM base",
        "validate_json_formats": f"""WITH {_BASE}, {_ENRICHED}, {_json_texts()}, {_json_checks()}
SELECT row_id, {", ".join(f"{k} IS NULL AS {k}_valid, coalesce(split_part({k}, ':', 1), '') AS {k}_rule, coalesce(TRY_CAST(NULLIF(split_part({k}, ':', 2), '') AS INTEGER), -1) AS {k}_place" for k in validate.JSON_ERRORS)} FROM e""",
        "validate_overall": f"""WITH {_BASE}, {_ENRICHED}, {_json_texts()}, {_json_checks()}, p AS (SELECT 'rows' AS part, count(*) FILTER (instruction IS NULL OR response IS NULL OR {blank('instruction')} OR {blank('response')}) = 0 AS is_valid FROM base
UNION ALL SELECT 'alpaca', count(alpaca) = 0 FROM e UNION ALL SELECT 'chatml', count(chatml) = 0 FROM e UNION ALL SELECT 'messages', count(messages) = 0 FROM e) SELECT * FROM p UNION ALL SELECT 'overall', bool_and(is_valid) FROM p""",
        "validate_encoding": _encoding_sql(),
        "eda_kde": _kde_sql(),
        "render_files": f"""WITH {_BASE} SELECT row_id, {_render(_TURNS)} AS chatml, {_render(_TURNS[:2], '<|im_start|>assistant' + chr(10))} AS prompt,
  concat('<s><<SYS>>\n', {_SYSTEM[1]}, '\n<</SYS>>\n[INST] ', {_re('instruction', rf'^[{_SPACE}]+|[{_SPACE}]+$', '')}, ' [/INST] ', response, '</s>') AS instructions FROM base""",
        "split_siblings": _SIBLINGS,
        "source_versions": f"WITH {_BASE} {_version('conversations', 'conversations', ('conv_id', 'turn', 'role', 'text'))} UNION ALL {_version('interactions', 'base', cols)}",
        "source_csv": f"WITH {_BASE} SELECT row_id, {', '.join(f'CASE WHEN {c} NOT IN ({na}) THEN {c} END AS {c}' for c in ('instruction', 'response', 'category', 'intent', 'flags'))} FROM base",
        "source_jsonl": f"WITH {_BASE} SELECT row_id, instruction, response, category, intent, flags FROM base",
        "source_json": f"WITH {_BASE} SELECT row_id, instruction, response, category, intent, flags FROM base",
        "source_splits": f"WITH {_BASE}, {_SPLIT} SELECT split, count(*) AS n, CAST(sum(length(instruction)) AS BIGINT) AS chars FROM parts GROUP BY split",
        "report_metrics": f"""WITH {_DIRTY_BASE}, {_CLEANED}, r AS ({_REMOVAL}) SELECT metric, CAST(value AS DOUBLE) AS value FROM (UNPIVOT r ON COLUMNS(*) INTO NAME metric VALUE value)""",
    }
    out |= {f"score_{c.removesuffix('_score')}": f"WITH {_BASE}, {_score_ctes('base')} SELECT row_id, {c} FROM scored" for c in (*score.WEIGHTS, "quality_score")}
    return out | {f"enrich_{c}": f"WITH {_BASE}, {_ENRICHED} SELECT row_id, {c} FROM enriched" for c in enrich.LABELS}
