"""Evaluation metrics (E1-E12, A11) over prediction tables derived by rule from the corpus tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from corpusprep.functions.text import pretokenize, words
from corpusprep.operators import metrics as mt
from corpusprep.operators import shape
from corpusprep.operators.ranking import below, seeded_uniform
from corpusprep.plans.corpus import WORDS_SQL
from corpusprep.plans.sequence_plans import ENC_SQL, encoded_docs_frame
from corpusprep.sources.tables import table

QUERIES = {}
SQL = {}


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


def _pred_frame(spark, sf_dir, threshold=1500):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(lab, "doc_id").withColumn("pred", (F.col("n_chars") > threshold).cast("int"))


METRIC_SQL = """
SELECT {by} count(*) AS n, count(*) FILTER (WHERE pred = quality) AS correct,
       count(*) FILTER (WHERE pred = 1 AND quality = 1) AS tp, count(*) FILTER (WHERE pred = 1 AND quality = 0) AS fp,
       count(*) FILTER (WHERE pred = 0 AND quality = 1) AS fn,
       round(count(*) FILTER (WHERE pred = quality) / count(*), 6) AS accuracy,
       round(CASE WHEN 2 * count(*) FILTER (WHERE pred = 1 AND quality = 1) + count(*) FILTER (WHERE pred <> quality) > 0
             THEN 2 * count(*) FILTER (WHERE pred = 1 AND quality = 1) /
                  (2 * count(*) FILTER (WHERE pred = 1 AND quality = 1) + count(*) FILTER (WHERE pred <> quality)) ELSE 0 END, 6) AS f1
FROM (SELECT d.doc_id, d.lang, CAST(d.n_chars > {t} AS INTEGER) AS pred, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
{group}"""


@register("quality_accuracy_f1", METRIC_SQL.format(by="lang,", t=1500, group="GROUP BY lang"))
def quality_accuracy_f1(spark, sf_dir):
    """Accuracy and binary F1 of a length rule against the quality labels, per language."""
    return mt.accuracy_f1(_pred_frame(spark, sf_dir), "pred", "quality", by=["lang"])


@register("quality_metrics_batched", METRIC_SQL.format(by="lang,", t=1500, group="GROUP BY lang"))
def quality_metrics_batched(spark, sf_dir):
    """The same metric accumulated over batches of 32 ids first; equals the whole-table one."""
    df = _pred_frame(spark, sf_dir).withColumn("batch", F.floor(F.col("doc_id") / 32))
    return mt.accumulate(df, "pred", "quality", "batch", by=["lang"])


@register("metric_delta_rules", f"""
WITH b AS ({METRIC_SQL.format(by='', t=1000, group='')}), a AS ({METRIC_SQL.format(by='', t=2000, group='')}),
bm AS (SELECT 'accuracy' AS metric, accuracy AS v FROM b UNION ALL SELECT 'f1', f1 FROM b),
am AS (SELECT 'accuracy' AS metric, accuracy AS v FROM a UNION ALL SELECT 'f1', f1 FROM a)
SELECT bm.metric, bm.v AS before, am.v AS after, round(am.v - bm.v, 6) AS delta, round((am.v - bm.v) / bm.v, 6) AS relative
FROM bm JOIN am ON bm.metric = am.metric""")
def metric_delta_rules(spark, sf_dir):
    """Accuracy and F1 before (rule n_chars > 1000) and after (n_chars > 2000), with deltas."""
    def long_form(t):
        m = mt.accuracy_f1(_pred_frame(spark, sf_dir, t), "pred", "quality")
        return m.select(F.explode(F.array(F.struct(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")),
                                          F.struct(F.lit("f1").alias("metric"), F.col("f1").alias("value")))).alias("m")) \
            .select("m.*")
    return shape.metric_delta(long_form(1000), long_form(2000))


# CoNLL-2003 tag names in id order.
NER_TAGS = ["O", "B-PER", "I-PER", "B-ORG", "I-ORG", "B-LOC", "I-LOC", "B-MISC", "I-MISC"]


def _hex_uniform(h, i: int) -> F.Column:
    """The i-th 8-hex-digit slice of an md5 hex string as a uniform number in [0, 1)."""
    return F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _tags_frame(spark, sf_dir):
    """Reference tags per word chosen by md5 (70% O), predictions = reference with 10% redrawn;
    words starting with an upper-case letter carry the ignore label -100 on the reference side.
    One md5 per word gives the three draws (hex digits 1-8, 9-16, 17-24)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", words("text").alias("w"))
    hashes = F.transform("w", lambda x, i: F.md5(F.concat_ws(":", F.lit("7"), F.lit("t"), F.col("doc_id").cast("string"),
                                                              i.cast("string"))))
    digits = lambda h, i: F.substring(h, 8 * i + 1, 8)
    tag = lambda h, i: F.when(below(digits(h, i), 0.7), F.lit(0)).otherwise((F.floor((_hex_uniform(h, i) - 0.7) / 0.3 * 8) + 1).cast("int"))
    z = F.arrays_zip(F.col("w").alias("x"), hashes.alias("h"))
    ref = F.transform("_z", lambda e: F.when(F.substring(e["x"], 1, 1).between("A", "Z"), F.lit(-100))
                      .otherwise(tag(e["h"], 0)))
    pred = F.transform("_z", lambda e: F.when(below(digits(e["h"], 1), 0.1), tag(e["h"], 2)).otherwise(tag(e["h"], 0)))
    return docs.select("doc_id", z.alias("_z")).select("doc_id", ref.alias("ref"), pred.alias("pred"))


def _tag_sql(slot: int) -> str:
    u = f"(('0x' || substr(h, {8 * slot + 1}, 8))::UBIGINT / 4294967296.0)"
    return f"CASE WHEN {u} < 0.7 THEN 0 ELSE CAST(floor(({u} - 0.7) / 0.3 * 8) + 1 AS INTEGER) END"


TAGS_SQL = f"""
w AS (SELECT doc_id, {WORDS_SQL.format(c='text')} AS w FROM documents),
wh AS (SELECT doc_id, w, list_transform(w, lambda x, i: md5(concat_ws(':', '7', 't', CAST(doc_id AS VARCHAR), CAST(i - 1 AS VARCHAR)))) AS hs FROM w),
tg AS (SELECT doc_id,
         list_transform(list_zip(w, hs), lambda e: CASE WHEN regexp_matches(substr(e[1], 1, 1), '^[A-Z]$') THEN -100
                                                        ELSE {_tag_sql(0).replace('(h,', '(e[2],')} END) AS ref,
         list_transform(hs, lambda h: CASE WHEN (('0x' || substr(h, 9, 8))::UBIGINT / 4294967296.0) < 0.1
                                         THEN {_tag_sql(2)} ELSE {_tag_sql(0)} END) AS pred FROM wh),
names AS (SELECT ['O', 'B-PER', 'I-PER', 'B-ORG', 'I-ORG', 'B-LOC', 'I-LOC', 'B-MISC', 'I-MISC'] AS nm),
kept AS (SELECT doc_id, list_transform(list_filter(list_zip(pred, ref), lambda e: e[2] <> -100), lambda e: nm[e[1] + 1]) AS p,
                list_transform(list_filter(list_zip(pred, ref), lambda e: e[2] <> -100), lambda e: nm[e[2] + 1]) AS r FROM tg, names)"""


def _spans_sql(col: str) -> str:
    return f"""(SELECT doc_id, typ, min(pos) AS st, max(pos) AS en FROM (
  SELECT *, sum(CASE WHEN typ IS NOT NULL AND (starts_with(tag, 'B-') OR ptyp IS NULL OR ptyp <> typ) THEN 1 ELSE 0 END)
            OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ent FROM (
    SELECT *, lag(typ) OVER (PARTITION BY doc_id ORDER BY pos) AS ptyp FROM (
      SELECT doc_id, pos, tag, CASE WHEN starts_with(tag, 'B-') OR starts_with(tag, 'I-') THEN substr(tag, 3) END AS typ FROM (
        SELECT doc_id, unnest({col}) AS tag, generate_subscripts({col}, 1) - 1 AS pos FROM kept))))
  WHERE typ IS NOT NULL GROUP BY doc_id, typ, ent)"""


@register("entity_scores_docs", f"""WITH {TAGS_SQL},
ps AS {_spans_sql('p')}, rs AS {_spans_sql('r')},
hit AS (SELECT ps.typ, count(*) AS tp FROM ps JOIN rs ON ps.doc_id = rs.doc_id AND ps.typ = rs.typ AND ps.st = rs.st AND ps.en = rs.en GROUP BY ps.typ),
np AS (SELECT typ, count(*) AS n_pred FROM ps GROUP BY typ), nr AS (SELECT typ, count(*) AS n_ref FROM rs GROUP BY typ),
per AS (SELECT coalesce(np.typ, nr.typ) AS type, coalesce(n_pred, 0) AS n_pred, coalesce(n_ref, 0) AS n_ref, coalesce(tp, 0) AS tp,
               CAST(NULL AS DOUBLE) AS accuracy
        FROM np FULL JOIN nr ON np.typ = nr.typ LEFT JOIN hit ON hit.typ = coalesce(np.typ, nr.typ)),
tok AS (SELECT round(avg(CASE WHEN e[1] = e[2] THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM (SELECT unnest(list_zip(p, r)) AS e FROM kept)),
al AS (SELECT * FROM per UNION ALL SELECT 'overall', sum(n_pred), sum(n_ref), sum(tp), (SELECT accuracy FROM tok) FROM per)
SELECT type, CAST(n_pred AS BIGINT) AS n_pred, CAST(n_ref AS BIGINT) AS n_ref, CAST(tp AS BIGINT) AS tp, accuracy,
       round(CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0 END, 6) AS precision,
       round(CASE WHEN n_ref > 0 THEN tp / n_ref ELSE 0 END, 6) AS recall,
       round(CASE WHEN tp > 0 THEN 2 * (tp / n_pred) * (tp / n_ref) / ((tp / n_pred) + (tp / n_ref)) ELSE 0 END, 6) AS f1
FROM al""")
def entity_scores_docs(spark, sf_dir):
    """E3 + E4: ignored positions dropped, ids -> tag names, entity-level P/R/F1 overall and per type."""
    tg = _tags_frame(spark, sf_dir)
    kept = tg.withColumn("k", mt.drop_ignored("pred", "ref", NER_TAGS)).select("doc_id", "k.pred", "k.ref")
    return mt.entity_scores(kept, "doc_id", "pred", "ref").select("type", "n_pred", "n_ref", "tp", "accuracy",
                                                                   "precision", "recall", "f1")


PUNCT_SQL = mt.PUNCTUATION.replace("'", "''")


# a text without its first line, and without its last
REST_SQL = "CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END"
HEAD_SQL = "regexp_replace(text, chr(10) || '[^' || chr(10) || ']*$', '')"


def without_first_line(c: str = "text"):
    return F.when(F.instr(c, "\n") > 0, F.substr(c, F.instr(c, "\n") + 1)).otherwise("")


def without_last_line(c: str = "text"):
    return F.regexp_replace(c, r"\n[^\n]*\z", "")


def _norm_sql(c: str) -> str:
    """DuckDB twin of ``metrics.squad_normalize`` (tokens a / an / the dropped)."""
    return ("list_filter(" + WORDS_SQL.format(c=f"translate(lower({c}), '{PUNCT_SQL}', '')")
            + ", lambda x: x NOT IN ('a', 'an', 'the'))")


@register("squad_scores_docs", f"""
WITH p AS (SELECT doc_id, array_to_string({_norm_sql("text")}, ' ') AS p FROM documents),
r AS (SELECT doc_id, 0 AS ref_id, array_to_string({_norm_sql(REST_SQL)}, ' ') AS r FROM documents
      UNION ALL SELECT doc_id, 1, array_to_string({_norm_sql(HEAD_SQL)}, ' ') FROM documents),
pr AS (SELECT p.doc_id, r.ref_id, p.p, r.r FROM p JOIN r ON p.doc_id = r.doc_id),
pt AS (SELECT doc_id, ref_id, tok, count(*) AS cp FROM (SELECT doc_id, ref_id, unnest({WORDS_SQL.format(c='p')}) AS tok FROM pr) GROUP BY ALL),
rt AS (SELECT doc_id, ref_id, tok, count(*) AS cr FROM (SELECT doc_id, ref_id, unnest({WORDS_SQL.format(c='r')}) AS tok FROM pr) GROUP BY ALL),
cm AS (SELECT pt.doc_id, pt.ref_id, sum(least(cp, cr)) AS same FROM pt JOIN rt USING (doc_id, ref_id, tok) GROUP BY ALL),
per AS (SELECT pr.doc_id, CASE WHEN p = r THEN 1.0 ELSE 0.0 END AS em, len({WORDS_SQL.format(c='p')}) AS np, len({WORDS_SQL.format(c='r')}) AS nr,
               coalesce(same, 0) AS same FROM pr LEFT JOIN cm ON pr.doc_id = cm.doc_id AND pr.ref_id = cm.ref_id),
f AS (SELECT doc_id, em, CASE WHEN np = 0 OR nr = 0 THEN CASE WHEN np = nr THEN 1.0 ELSE 0.0 END WHEN same = 0 THEN 0.0
                             ELSE 2 * (same / np) * (same / nr) / ((same / np) + (same / nr)) END AS f1 FROM per),
b AS (SELECT doc_id, max(em) AS em, max(f1) AS f1 FROM f GROUP BY doc_id)
SELECT round(100 * avg(em), 4) AS exact_match, round(100 * avg(f1), 4) AS f1 FROM b""")
def squad_scores_docs(spark, sf_dir):
    """Every whole document as the prediction against two references (the document without its first
    line and without its last): exact match and token F1 after SQuAD normalisation, x100."""
    docs = table(spark, sf_dir, "documents")
    pred = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("prediction_text"))
    ref = docs.select(F.col("doc_id").alias("id"), F.array(without_first_line(), without_last_line()).alias("answers"))
    return mt.squad_scores(pred, ref, "id")


TOK_SQL = "regexp_extract_all({c}, '[\\p{{L}}\\p{{N}}_\\p{{M}}]+|[^\\p{{L}}\\p{{N}}_\\p{{M}}\\s]')"


def _bleu_sql() -> str:
    """DuckDB twin of ``metrics.corpus_bleu`` over the previous / next document of each source."""
    ctes = [f"""nb AS (SELECT doc_id, text, lag(text) OVER (PARTITION BY source ORDER BY doc_id) AS pv,
                   lead(text) OVER (PARTITION BY source ORDER BY doc_id) AS nx FROM documents),
p AS (SELECT doc_id, {TOK_SQL.format(c='text')} AS h, list_filter([pv, nx], lambda x: x IS NOT NULL) AS refs FROM nb),
lens AS (SELECT doc_id, h, list_transform(refs, lambda r: {TOK_SQL.format(c='r')}) AS rs FROM p WHERE len(refs) > 0),
refs_ex AS (SELECT doc_id, unnest(rs) AS r, generate_subscripts(rs, 1) AS ri FROM lens),
closest AS (SELECT doc_id, arg_min(rl, (abs(rl - hl), rl)) AS cl FROM (
              SELECT l.doc_id, len(l.h) AS hl, len(e.r) AS rl FROM lens l JOIN refs_ex e ON l.doc_id = e.doc_id) GROUP BY doc_id),
tot AS (SELECT CAST((SELECT sum(len(h)) FROM lens) AS BIGINT) AS c, CAST((SELECT sum(cl) FROM closest) AS BIGINT) AS r)"""]
    for n in range(1, 5):
        ctes.append(f"""hg{n} AS (SELECT doc_id, g, count(*) AS c FROM (
    SELECT doc_id, array_to_string(h[i:i + {n - 1}], chr(1)) AS g FROM (SELECT doc_id, h, unnest(range(1, len(h) - {n - 2})) AS i FROM lens))
  GROUP BY doc_id, g),
rg{n} AS (SELECT doc_id, g, max(c) AS rc FROM (SELECT doc_id, ri, g, count(*) AS c FROM (
    SELECT doc_id, ri, array_to_string(r[i:i + {n - 1}], chr(1)) AS g FROM (SELECT doc_id, ri, r, unnest(range(1, len(r) - {n - 2})) AS i FROM refs_ex))
  GROUP BY doc_id, ri, g) GROUP BY doc_id, g),
st{n} AS (SELECT CAST(coalesce(sum(least(h.c, coalesce(r.rc, 0))), 0) AS DOUBLE) AS m, CAST(coalesce(sum(h.c), 0) AS DOUBLE) AS t
          FROM hg{n} h LEFT JOIN rg{n} r ON h.doc_id = r.doc_id AND h.g = r.g)""")
    k = []
    logs = []
    for n in range(1, 5):
        k.append(" * ".join(f"(CASE WHEN st{j}.m = 0 THEN 2 ELSE 1 END)" for j in range(1, n + 1)))
        logs.append(f"CASE WHEN st{n}.m = 0 THEN ln(1.0 / (({k[-1]}) * st{n}.t)) ELSE ln(st{n}.m / st{n}.t) END")
    bleu = (f"CASE WHEN tot.c = 0 OR st1.t = 0 OR st2.t = 0 OR st3.t = 0 OR st4.t = 0 THEN 0.0 ELSE 100 * "
            f"(CASE WHEN tot.c >= tot.r THEN 1.0 ELSE exp(1 - tot.r / tot.c) END) * exp(({' + '.join(logs)}) / 4) END")
    prec = ", ".join(f"round(CASE WHEN st{n}.t > 0 THEN 100.0 * st{n}.m / st{n}.t ELSE 0.0 END, 4) AS p{n}" for n in range(1, 5))
    return ("WITH " + ",\n".join(ctes) + f"""
SELECT round({bleu}, 4) AS bleu, {prec}, tot.c AS sys_len, tot.r AS ref_len FROM tot, st1, st2, st3, st4""")


@register("bleu_doc_pairs", _bleu_sql())
def bleu_doc_pairs(spark, sf_dir):
    """Corpus BLEU of every document against the previous and next document of its source."""
    from corpusprep.operators.ranking import neighbor_values
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    keys = docs.select("doc_id", "source", F.col("doc_id").alias("id"))
    nb = neighbor_values(neighbor_values(keys, "source", "doc_id", ["id"], -1, "prev_"), "source", "doc_id", ["id"], 1, "next_")
    # a text goes to its own row, to the next and to the previous one: one shuffle, only keys in the windows
    sent = docs.join(nb.select("doc_id", "prev_id", "next_id"), "doc_id").select("text", F.explode(F.array(
        F.struct(F.col("doc_id").alias("to"), F.lit(0).alias("as")), F.struct(F.col("next_id").alias("to"), F.lit(1).alias("as")),
        F.struct(F.col("prev_id").alias("to"), F.lit(2).alias("as")))).alias("s")).where("s.to is not null")
    as_ = lambda k: F.max(F.when(F.col("s.as") == k, F.col("text")))
    pairs = sent.groupBy(F.col("s.to").alias("doc_id")).agg(as_(0).alias("text"), as_(1).alias("prev_text"), as_(2).alias("next_text")) \
        .select("doc_id", "text", F.array_compact(F.array("prev_text", "next_text")).alias("refs"))
    return mt.corpus_bleu(pairs.where(F.size("refs") > 0), "doc_id", "text", "refs")


ROUGE_TOK = "list_filter(string_split(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"


def _ngram_sql(n: int, src: str, col: str) -> str:
    return (f"SELECT doc_id, g, count(*) AS c FROM (SELECT doc_id, array_to_string({col}[i:i + {n - 1}], chr(1)) AS g "
            f"FROM (SELECT doc_id, {col}, unnest(range(1, len({col}) - {n - 1} + 1)) AS i FROM {src})) GROUP BY doc_id, g")


@register("rouge_n_pairs", f"""
WITH t AS (SELECT doc_id, {ROUGE_TOK.format(c=REST_SQL)} AS h, {ROUGE_TOK.format(c="text")} AS r FROM documents),
o1 AS (SELECT h.doc_id, sum(least(h.c, r.c)) AS o FROM ({_ngram_sql(1, 't', 'h')}) h JOIN ({_ngram_sql(1, 't', 'r')}) r USING (doc_id, g) GROUP BY h.doc_id),
o2 AS (SELECT h.doc_id, sum(least(h.c, r.c)) AS o FROM ({_ngram_sql(2, 't', 'h')}) h JOIN ({_ngram_sql(2, 't', 'r')}) r USING (doc_id, g) GROUP BY h.doc_id),
s AS (SELECT t.doc_id, len(h) AS nh, len(r) AS nr, coalesce(o1.o, 0) AS a1, coalesce(o2.o, 0) AS a2 FROM t
      LEFT JOIN o1 ON t.doc_id = o1.doc_id LEFT JOIN o2 ON t.doc_id = o2.doc_id),
m AS (SELECT CASE WHEN nh > 0 THEN a1 / nh ELSE 0 END AS p1, CASE WHEN nr > 0 THEN a1 / nr ELSE 0 END AS r1,
             CASE WHEN nh > 1 THEN a2 / (nh - 1) ELSE 0 END AS p2, CASE WHEN nr > 1 THEN a2 / (nr - 1) ELSE 0 END AS r2 FROM s)
SELECT round(avg(CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END), 6) AS rouge1,
       round(avg(CASE WHEN p2 + r2 > 0 THEN 2 * p2 * r2 / (p2 + r2) ELSE 0 END), 6) AS rouge2,
       round(avg(r1), 6) AS rouge1_recall, round(avg(r2), 6) AS rouge2_recall FROM m""")
def rouge_n_pairs(spark, sf_dir):
    """E8 (n-gram part): ROUGE-1/2 of every document without its first line against the whole document."""
    r = _rouge_frame(spark, sf_dir)
    return r.select("rouge1", "rouge2", "rouge1_recall", "rouge2_recall")


def _rouge_frame(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    pairs = docs.select("doc_id", without_first_line().alias("pred"), F.col("text").alias("ref"))
    return mt.rouge(pairs, "doc_id", "pred", "ref")


@register("rouge_l_pairs")
def rouge_l_pairs(spark, sf_dir):
    """E8 (LCS part): ROUGE-L of every document without its first line against the whole document."""
    return _rouge_frame(spark, sf_dir).select("rougeL", "rougeL_recall")


LOSS_EXPR = "ln(1 + (x % 7))"


@register("pseudo_perplexity", f"""WITH {ENC_SQL},
l AS (SELECT lang, ids, list_transform(ids, lambda x: {LOSS_EXPR}) AS losses FROM e WHERE len(ids) > 0)
SELECT lang, round(avg(list_sum(losses) / len(losses)), 6) AS mean_loss,
       round(exp(avg(list_sum(losses) / len(losses))), 6) AS perplexity,
       round(avg(list_sum(losses) / len(losses) * 0.5 * (1 + len(list_filter(ids, lambda x: x IN (1000, 1001, 1002))))), 6) AS weighted_loss
FROM l GROUP BY lang""")
def pseudo_perplexity(spark, sf_dir):
    """E9 + E10: per-row losses derived from the ids (ln(1 + id mod 7)); perplexity = exp(mean of
    row means) and the key-token weighted loss with the three most frequent words as key tokens."""
    enc = encoded_docs_frame(spark, sf_dir).where(F.size("ids") > 0)
    enc = enc.withColumn("losses", F.transform("ids", lambda x: F.log(1 + (x % 7))))
    rows = enc.withColumn("row_loss", F.aggregate("losses", F.lit(0.0), lambda a, x: a + x) / F.size("losses"))
    p = mt.perplexity(rows, "row_loss", by=["lang"])
    wl = mt.weighted_loss(enc, "losses", "ids", [1000, 1001, 1002], alpha=0.5, by=["lang"])
    return p.join(wl, "lang").select("lang", F.round("mean_loss", 6).alias("mean_loss"),
                                     F.round("perplexity", 6).alias("perplexity"),
                                     F.round("weighted_loss", 6).alias("weighted_loss"))


@register("embedding_topk_softmax", """
WITH x AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) - 1 AS token_id FROM embeddings),
m AS (SELECT vec_id, max(v) AS mv FROM x GROUP BY vec_id),
p AS (SELECT x.vec_id, token_id, exp(v - mv) AS e FROM x JOIN m ON x.vec_id = m.vec_id),
s AS (SELECT vec_id, token_id, e / sum(e) OVER (PARTITION BY vec_id) AS prob FROM p)
SELECT vec_id, CAST(token_id AS INTEGER) AS token_id, round(prob, 6) AS prob, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY prob DESC, token_id) AS rank FROM s) WHERE rank <= 5""")
def embedding_topk_softmax(spark, sf_dir):
    """Every stored vector read as logits over 64 ids; the five most probable ids."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("logits"))
    top = mt.top_candidates(e, "vec_id", "logits", 5)
    return top.select("vec_id", F.col("token_id").cast("int").alias("token_id"), F.round("prob", 6).alias("prob"), "rank")


def _best_answers_sql() -> str:
    """DuckDB twin of ``qa_best_answers`` (windows of label_plans._windows, md5 logits)."""
    from corpusprep.plans.sequence_plans import ENC_SQL
    u = lambda kind: (f"(('0x' || substr(md5(concat_ws(':', '{kind}', CAST(doc_id AS VARCHAR), CAST(window_id AS VARCHAR), "
                      f"CAST(t AS VARCHAR))), 1, 8))::UBIGINT / 4294967296.0) * 10")  # noqa: E731
    return f"""WITH {ENC_SQL},
qa AS (SELECT doc_id, len(ids[1:8]) AS nq, len(ids) AS nt FROM e WHERE len(ids) >= 4),
p AS (SELECT *, 61 - nq AS payload, 61 - nq - 16 AS step FROM qa),
w AS (SELECT *, unnest(range(0, CASE WHEN nt <= payload THEN 1 ELSE 1 + CAST(ceil((nt - payload) / step) AS BIGINT) END)) AS window_id FROM p),
s AS (SELECT *, window_id * step AS cs, least(payload, nt - window_id * step) AS L FROM w),
tok AS (SELECT doc_id, window_id, nq, cs, L, unnest(range(0, nq + 3 + L)) AS t FROM s),
lg AS (SELECT *, {u('s')} AS sl, {u('e')} AS el,
              CASE WHEN t >= nq + 2 AND t < nq + 2 + L THEN cs + t - nq - 2 END AS word FROM tok),
st AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, window_id ORDER BY sl DESC, t) AS r FROM lg)
       WHERE r <= 20 AND word IS NOT NULL),
en AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, window_id ORDER BY el DESC, t) AS r FROM lg)
       WHERE r <= 20 AND word IS NOT NULL),
pr AS (SELECT st.doc_id, st.word AS sw, en.word AS ew, st.sl + en.el AS score FROM st JOIN en
       ON st.doc_id = en.doc_id AND st.window_id = en.window_id AND en.t >= st.t AND en.t - st.t <= 29),
wd AS (SELECT doc_id, text, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS ws,
              string_split_regex(text, '\\S+') AS seps FROM documents),
ch AS (SELECT pr.doc_id, pr.score,
              coalesce(list_sum(list_transform(wd.ws[1:pr.sw], lambda x: length(x))), 0)
              + coalesce(list_sum(list_transform(wd.seps[1:pr.sw + 1], lambda x: length(x))), 0) AS s_char,
              coalesce(list_sum(list_transform(wd.ws[1:pr.ew + 1], lambda x: length(x))), 0)
              + coalesce(list_sum(list_transform(wd.seps[1:pr.ew + 1], lambda x: length(x))), 0) AS e_char
       FROM pr JOIN wd ON pr.doc_id = wd.doc_id),
best AS (SELECT doc_id, arg_max(s_char, (score, -s_char, -e_char)) AS bs, arg_max(e_char, (score, -s_char, -e_char)) AS be,
                max(score) AS score FROM ch GROUP BY doc_id)
SELECT d.doc_id AS example_id, CASE WHEN best.doc_id IS NULL THEN '' ELSE substr(d.text, CAST(bs + 1 AS BIGINT), CAST(be - bs AS BIGINT)) END AS prediction_text,
       best.score AS score
FROM documents d LEFT JOIN best ON d.doc_id = best.doc_id"""


@register("qa_best_answers", _best_answers_sql())
def qa_best_answers(spark, sf_dir):
    """E5 (+J4, J5): windows of 48 words with stride 16 over every document, md5-made start/end
    logits per word, the best valid span (<= 30 words) over all windows of the document."""
    from corpusprep.plans.label_plans import qa_logits_frame
    feats, examples = qa_logits_frame(spark, sf_dir)
    return mt.best_answers(feats, examples, n_best=20, max_len=30)
