"""Web page analytics queries (W1-W10, S9, P19, A10) over the pages table."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.operators import web
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


# Markup of the given pages that regular expressions can read: text outside scripts, styles and comments, headings
# and links closed by their own end tag, and the four character references that occur.
_CLEAN = r"""regexp_replace(regexp_replace(html, '<(script|style)>.*?</(script|style)>', '', 'gs'), '<!--.*?-->', '', 'gs')"""


def _text_sql(c: str) -> str:
    bare = f"regexp_replace({c}, '<[^>]*>', '', 'g')"
    for ref, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "''"), ("&nbsp;", chr(0xA0)), ("&amp;", "&")):
        bare = f"replace({bare}, '{ref}', '{char}')"
    return f"trim({bare}, chr(32) || chr(9) || chr(10) || chr(13) || chr(160))"


def _parsed(spark, sf_dir):
    return web.parse_pages(table(spark, sf_dir, "pages"))


@register("page_outline")
def page_outline(spark, sf_dir):
    """Title with fallbacks, heading / paragraph / link / image counts,
    meta description and visible body size of every page."""
    p = _parsed(spark, sf_dir)
    counts = web.page_element_counts()
    return p.select("page_id", web.page_title().alias("title"), web.page_file_name().alias("file_name"),
                    F.size("parsed.headings").alias("n_headings"), F.size("parsed.paragraphs").alias("n_paragraphs"),
                    counts["n_links"].alias("n_links"), counts["n_images"].alias("n_images"),
                    web.meta_description().alias("description"), F.length(web.body_text()).alias("body_chars"))


@register("page_headings", rf"""
WITH m AS (SELECT page_id, regexp_extract_all({_CLEAN}, '(?s)<h[1-6][^>]*>.*?</h[1-6]>') AS ms FROM pages),
e AS (SELECT page_id, unnest(ms) AS m, generate_subscripts(ms, 1) AS n FROM m),
t AS (SELECT page_id, n, 'h' || m[3:3] AS level, {_text_sql("m")} AS text FROM e)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS INTEGER) AS position, level, text FROM t WHERE text <> ''""")
def page_headings(spark, sf_dir):
    """One row per non-empty heading in document order."""
    return web.headings(_parsed(spark, sf_dir), "page_id")


@register("page_links", rf"""
WITH m AS (SELECT page_id, regexp_extract_all({_CLEAN}, '(?s)<a [^>]*href="[^"]*"[^>]*>.*?</a>') AS ms FROM pages),
e AS (SELECT page_id, unnest(ms) AS m, generate_subscripts(ms, 1) AS n FROM m),
t AS (SELECT page_id, n, regexp_extract(m, 'href="([^"]*)"', 1) AS href, {_text_sql("m")} AS text FROM e)
SELECT page_id, CAST(n - 1 AS INTEGER) AS position, CASE WHEN text = '' THEN '{web.NO_LINK_TEXT}' ELSE text END AS text,
       replace(href, '&amp;', '&') AS href FROM t""")
def page_links(spark, sf_dir):
    """Link table (text or placeholder, href), only links with an href."""
    return web.links(_parsed(spark, sf_dir), "page_id")


@register("page_paragraphs")
def page_paragraphs(spark, sf_dir):
    """One row per non-empty paragraph."""
    return web.paragraphs(_parsed(spark, sf_dir), "page_id")


@register("page_detection")
def page_detection(spark, sf_dir):
    """Framework, dynamic confidence, login test and crawler route per page."""
    p = _parsed(spark, sf_dir)
    d = web.dynamic_score()
    lg = web.login_check()
    out = p.select("page_id", web.framework("html").alias("framework"), d["confidence"].alias("confidence"),
                   d["is_dynamic"].alias("is_dynamic"), lg["is_login"].alias("is_login"), F.size(lg["reasons"]).alias("n_reasons"))
    return out.withColumn("route", web.page_route(F.col("is_dynamic"), F.col("is_login")))


@register("page_render")
def page_render(spark, sf_dir):
    """W9 + S9: safe file name and text rendering (headings, body, first 20 links) per page."""
    r = web.render_text(_parsed(spark, sf_dir))
    return r.select("page_id", "file_name", F.length("rendered").alias("rendered_chars"), F.md5("rendered").alias("rendered_md5"))


def _fw_sql() -> str:
    cases = []
    for name, pats in reversed(list(web.FRAMEWORK_SIGNATURES.items())):
        pat = "(?i)" + "|".join(f"(?:{p})" for p in pats)
        cases.append(f"WHEN regexp_matches(html, '{pat}') THEN '{name}'")
    return "CASE " + " ".join(cases) + " END"


def _hits_sql() -> str:
    fw = " + ".join(
        "CAST(regexp_matches(html, '" + "(?i)" + "|".join(f"(?:{p})" for p in pats) + "') AS INTEGER)"
        for pats in web.FRAMEWORK_SIGNATURES.values())
    sc = " + ".join(f"CAST(regexp_matches(html, '{p}') AS INTEGER)" for p in web.DYNAMIC_SIGNATURES)
    return fw, sc


def _login_sql() -> str:
    pats = " + ".join(f"CAST(regexp_matches(h, '(?i){p}') AS INTEGER)" for p in web.LOGIN_SIGNATURES)
    title_words = " OR ".join(f"contains(t, '{w}')" for w in web.LOGIN_TITLE_WORDS)
    form_words = " OR ".join(f"contains(f, '{w}')" for w in web.LOGIN_FORM_WORDS)
    return (f"({pats}) + CAST(regexp_matches(h, '<input[^>]*type\\s*=\\s*[''\"]?password') AS INTEGER)"
            f" + CAST(({title_words}) AS INTEGER)"
            f" + CAST(len(list_filter(forms, lambda f: {form_words})) > 0 AS INTEGER)")


_FW_HITS, _SC_HITS = _hits_sql()


@register("page_signatures", f"""
WITH l AS (SELECT page_id, html, lower(html) AS h FROM pages),
t AS (SELECT *, regexp_extract(h, '(?s)<title[^>]*>(.*?)</title>', 1) AS t,
             regexp_extract_all(h, '(?s)<form\\b.*?</form>') AS forms FROM l)
SELECT page_id, {_fw_sql()} AS framework, CAST({_FW_HITS} AS INTEGER) AS framework_hits,
       CAST({_SC_HITS} AS INTEGER) AS script_hits, CAST({_login_sql()} AS INTEGER) AS login_reasons
FROM t""")
def page_signatures(spark, sf_dir):
    """W6 + W8 on raw HTML: framework (last match wins), signature hit counts and login reasons."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", web.framework("html").alias("framework"), web.framework_hits("html").alias("framework_hits"),
                    web.script_hits("html").alias("script_hits"),
                    F.size(web.login_reasons("html", parsed=None)).alias("login_reasons"))


@register("page_unescaped_body")
def page_unescaped_body(spark, sf_dir):
    """W10 + T2: visible body text (character references already decoded by the parser)."""
    p = _parsed(spark, sf_dir)
    return p.select("page_id", F.md5(web.body_text()).alias("body_md5"), F.length(web.body_text()).alias("body_chars"))
