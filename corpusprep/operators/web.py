"""Web page analytics (W1-W10, S9, P19, A10) as a batch job over a pages table.

HTML is parsed once per page inside ``mapInArrow`` with the standard-library HTMLParser into a
struct of the parts every operator needs; everything after that (fallbacks, explodes, scores,
routing, rendering) is native column work.  Signature tests (W6, W8 patterns) run on the raw
HTML with Java regexes and need no parse.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusprep.functions.batches import parts, text_sizes
from corpusprep.functions.text import safe_name, safe_name_replace

# Signatures and thresholds of the reference's page-type detector.
FRAMEWORK_SIGNATURES = {
    "React": [r"data-reactroot", r"react-dom", r"__REACT_DEVTOOLS"],
    "Vue": [r"data-v-[a-f0-9]+", r"__vue__", r"Vue\."],
    "Angular": [r"ng-version", r"ng-app", r"angular\.module"],
    "Next.js": [r"__NEXT_DATA__", r"_next/static"],
    "SPA": [r"window\.__INITIAL_STATE__", r"bundle\..*\.js", r"main\..*\.js"],
}
DYNAMIC_SIGNATURES = [r"document\.write", r"innerHTML", r"fetch\(", r"axios\.", r"XMLHttpRequest", r"\.ajax\("]
LOGIN_SIGNATURES = [
    r"login", r"signin", r"sign-in", r"登录", r"登陆",
    r"auth", r"authenticate", r"password", r"密码",
    r"<form.*action.*login", r'type="password"',
    r"请登录", r"请先登录", r"需要登录",
]
LOGIN_TITLE_WORDS = ["login", "登录", "signin", "sign in", "auth"]
LOGIN_FORM_WORDS = ["login", "登录", "signin", "password", "auth"]
FRAMEWORK_SCORE, SCRIPT_SCORE, THIN_BODY_SCORE, EMPTY_DIV_SCORE = 0.7, 0.2, 0.8, 0.5
THIN_BODY_CHARS, DYNAMIC_AT = 50, 0.5
NO_LINK_TEXT = "[无文本]"
RENDER_LABELS = {"url": "来源URL: ", "title": "页面标题: ", "body": "\n【正文】", "links": "\n【链接】"}
RENDER_LINKS, LINK_TEXT_CHARS, META_CHARS = 20, 30, 100

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HIDDEN = {"script", "style", "template"}

LINK_T = T.StructType([T.StructField("text", T.StringType()), T.StructField("href", T.StringType())])
HEAD_T = T.StructType([T.StructField("level", T.StringType()), T.StructField("text", T.StringType())])
PARSED_T = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("h1", T.StringType()),
    T.StructField("og_title", T.StringType()), T.StructField("meta_description", T.StringType()),
    T.StructField("headings", T.ArrayType(HEAD_T)), T.StructField("paragraphs", T.ArrayType(T.StringType())),
    T.StructField("links", T.ArrayType(LINK_T)), T.StructField("n_images", T.IntegerType()),
    T.StructField("has_body", T.BooleanType()), T.StructField("body_text", T.StringType()),
    T.StructField("n_divs", T.IntegerType()), T.StructField("n_empty_divs", T.IntegerType()),
    T.StructField("n_password_inputs", T.IntegerType()), T.StructField("error", T.StringType()),
])
PARSED_ARROW = to_arrow_type(PARSED_T)


class _PageParser(HTMLParser):
    """Text, links and counts of a page in document order.

    All visible text pieces go to one list; an open element keeps the place where its text begins,
    so a piece is stored once however deep it stands.  An element takes its slot in the result when
    it starts and fills it when it ends (an end tag closes the inner elements still open, as a tree
    builder would).  Script, style and template text is not text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.filled = [0]  # filled[i]: non-blank pieces among the first i
        self.stack: list[tuple] = []  # (tag, first piece, result list, slot, link target)
        self.hidden = 0
        self.title = self.h1 = self.og = self.meta_desc = None
        self.headings, self.paragraphs, self.links, self.divs = [], [], [], []
        self.images = self.passwords = 0
        self.body = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "img":
            self.images += 1
        if tag == "input" and (a.get("type") or "").lower() == "password":
            self.passwords += 1
        if tag == "meta":
            if a.get("property") == "og:title" and self.og is None:
                self.og = a.get("content")
            if a.get("name") == "description" and self.meta_desc is None:
                self.meta_desc = a.get("content")
        if tag in HIDDEN:
            self.hidden += 1
        if tag in VOID:
            return
        into = None
        if tag in HEADINGS:
            into = self.headings
        elif tag == "p":
            into = self.paragraphs
        elif tag == "div":
            into = self.divs
        elif tag == "a" and "href" in a:
            into = self.links
        if into is not None:
            into.append(None)
        self.stack.append((tag, len(self.pieces), into, len(into) - 1 if into is not None else -1, a.get("href") or ""))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in HIDDEN and self.hidden:
            self.hidden -= 1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                while len(self.stack) > i:
                    self._close(*self.stack.pop())
                return

    def handle_data(self, data):
        if not self.hidden:
            self.pieces.append(data)
            self.filled.append(self.filled[-1] + bool(data.strip()))

    def _close(self, tag, first, into, slot, href):
        if tag == "div":
            into[slot] = self.filled[-1] > self.filled[first]
            return
        if into is None and tag not in ("title", "body"):
            return
        if tag == "body":
            if self.body is None:
                self.body = "".join(piece.strip() for piece in self.pieces[first:])
            return
        text = "".join(self.pieces[first:])
        if tag == "title":
            if self.title is None:
                self.title = text
        elif tag == "p":
            into[slot] = text.strip()
        elif tag == "a":
            into[slot] = {"text": text.strip(), "href": href}
        else:
            into[slot] = {"level": tag, "text": text.strip()}
            if tag == "h1" and self.h1 is None:
                self.h1 = text

    def result(self, error: str | None = None):
        while self.stack:
            self._close(*self.stack.pop())
        return {
            "title": self.title, "h1": self.h1, "og_title": self.og, "meta_description": self.meta_desc,
            "headings": [h for h in self.headings if h and h["text"]], "paragraphs": [p for p in self.paragraphs if p],
            "links": [link for link in self.links if link], "n_images": self.images, "has_body": self.body is not None,
            "body_text": self.body, "n_divs": len(self.divs), "n_empty_divs": sum(not d for d in self.divs),
            "n_password_inputs": self.passwords, "error": error,
        }


def parse_html(html: str | None) -> dict | None:
    """The parts of one page; ``error`` names the parser's exception when only the start could be read."""
    if html is None:
        return None
    p, error = _PageParser(), None
    try:
        p.feed(html)
        p.close()
    except Exception as e:  # noqa: BLE001 - a broken page yields what was parsed, and says so
        error = f"{type(e).__name__}: {e}"
    return p.result(error)


def parse_pages(df: DataFrame, html: str = "html", out: str = "parsed") -> DataFrame:
    """One parse per page, partition-local (no shuffle); adds the ``parsed`` struct column.  A batch is parsed in
    parts (``functions.batches``), so a task holds the parts of a few pages as Python objects at a time."""
    schema = T.StructType(list(df.schema.fields) + [T.StructField(out, PARSED_T)])

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(html)
            for part in parts(batch, text_sizes(batch.column(at))):
                parsed = pa.array([parse_html(h) for h in part.column(at).to_pylist()], PARSED_ARROW)
                yield pa.RecordBatch.from_arrays([*part.columns, parsed], names=[*part.schema.names, out])

    return df.mapInArrow(run, schema)


def _nz(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def page_title(parsed: str = "parsed") -> Column:
    """<title>, else first <h1>, else og:title, else 'untitled' (stripped text)."""
    p = F.col(parsed)
    return F.coalesce(_nz(p["title"]), _nz(p["h1"]), _nz(p["og_title"]), F.lit("untitled"))


def page_file_name(parsed: str = "parsed") -> Column:
    """W1 as used for file names: the title made safe (illegal characters -> '_')."""
    return safe_name_replace(page_title(parsed))


def headings(df: DataFrame, key: str, parsed: str = "parsed") -> DataFrame:
    """Headings h1-h6 in document order, empty ones skipped."""
    return df.select(key, F.posexplode(F.col(parsed)["headings"]).alias("position", "h")).select(key, "position", "h.level", "h.text")


def paragraphs(df: DataFrame, key: str, parsed: str = "parsed") -> DataFrame:
    """W3"""
    return df.select(key, F.posexplode(F.col(parsed)["paragraphs"]).alias("position", "text"))


def links(df: DataFrame, key: str, parsed: str = "parsed") -> DataFrame:
    """Links with an href; empty text replaced by the placeholder."""
    ex = df.select(key, F.posexplode(F.col(parsed)["links"]).alias("position", "l"))
    return ex.select(key, "position", F.when(F.col("l.text") == "", F.lit(NO_LINK_TEXT)).otherwise(F.col("l.text")).alias("text"),
                     F.col("l.href").alias("href"))


def meta_description(parsed: str = "parsed") -> Column:
    """Meta description cut at 100 characters."""
    return F.substring(F.col(parsed)["meta_description"], 1, META_CHARS)


def framework(html) -> Column:
    """The last framework (in signature order) with any matching pattern, case-insensitive."""
    h = F.col(html) if isinstance(html, str) else html
    out = F.lit(None).cast("string")
    for name, pats in FRAMEWORK_SIGNATURES.items():
        out = F.when(h.rlike("(?i)" + "|".join(f"(?:{p})" for p in pats)), F.lit(name)).otherwise(out)
    return out


def framework_hits(html) -> Column:
    h = F.col(html) if isinstance(html, str) else html
    return sum(h.rlike("(?i)" + "|".join(f"(?:{p})" for p in pats)).cast("int") for pats in FRAMEWORK_SIGNATURES.values())


def script_hits(html) -> Column:
    h = F.col(html) if isinstance(html, str) else html
    return sum(h.rlike(p).cast("int") for p in DYNAMIC_SIGNATURES)


def dynamic_score(html: str = "html", parsed: str = "parsed") -> Column:
    """struct(confidence capped at 1, is_dynamic)."""
    p = F.col(parsed)
    thin = (p["has_body"] & (F.length(p["body_text"]) < THIN_BODY_CHARS)).cast("int")
    empty = ((p["n_divs"] > 0) & (p["n_empty_divs"] / p["n_divs"] > 0.5)).cast("int")
    conf = framework_hits(html) * FRAMEWORK_SCORE + script_hits(html) * SCRIPT_SCORE + thin * THIN_BODY_SCORE + empty * EMPTY_DIV_SCORE
    return F.struct(F.round(F.least(conf, F.lit(1.0)), 4).alias("confidence"), (conf >= DYNAMIC_AT).alias("is_dynamic"))


def login_reasons(html: str = "html", parsed: str | None = "parsed") -> Column:
    """One reason per matching login pattern (case-insensitive), the password input, a title
    word and the first form containing a login word; without a parse the last three use regexes."""
    h = F.lower(F.col(html))
    reasons = [F.when(h.rlike("(?i)" + p), F.lit(f"pattern: {p}")) for p in LOGIN_SIGNATURES]
    if parsed:
        pw = F.col(parsed)["n_password_inputs"] > 0
        title = F.lower(F.coalesce(F.col(parsed)["title"], F.lit("")))
    else:
        pw = h.rlike(r"<input[^>]*type\s*=\s*['\"]?password")
        title = F.regexp_extract(h, r"(?s)<title[^>]*>(.*?)</title>", 1)
    reasons.append(F.when(pw, F.lit("password input")))
    reasons.append(F.when(F.exists(F.array(*[F.lit(w) for w in LOGIN_TITLE_WORDS]), lambda w: F.instr(title, w) > 0),
                          F.lit("login word in title")))
    forms = F.regexp_extract_all(h, F.lit(r"(?s)<form\b.*?</form>"), 0)
    reasons.append(F.when(F.exists(forms, lambda f: F.exists(F.array(*[F.lit(w) for w in LOGIN_FORM_WORDS]),
                                                             lambda w: F.instr(f, w) > 0)), F.lit("login form")))
    return F.array_compact(F.array(*reasons))


def login_check(html: str = "html", parsed: str | None = "parsed") -> Column:
    """struct(is_login = at least two reasons, reasons)."""
    r = login_reasons(html, parsed)
    return F.struct((F.size(r) >= 2).alias("is_login"), r.alias("reasons"))


def body_text(parsed: str = "parsed") -> Column:
    """Visible body text, every piece stripped, joined without a gap."""
    return F.col(parsed)["body_text"]


def page_element_counts(parsed: str = "parsed") -> Column:
    """A10: links with href and images."""
    p = F.col(parsed)
    return F.struct(F.size(p["links"]).alias("n_links"), p["n_images"].alias("n_images"))


def render_text_column(url: str = "url", parsed: str = "parsed", max_links: int = RENDER_LINKS) -> Column:
    """Source URL, title, rule, '[hN] text' headings, body paragraphs, first links as
    'text -> href' (text cut at 30)."""
    p = F.col(parsed)
    head = F.array(F.concat(F.lit(RENDER_LABELS["url"]), F.col(url)), F.concat(F.lit(RENDER_LABELS["title"]), page_title(parsed)),
                   F.lit("=" * 50))
    hs = F.transform(p["headings"], lambda h: F.concat(F.lit("\n["), h["level"], F.lit("] "), h["text"]))
    body = F.concat(F.array(F.lit(RENDER_LABELS["body"])), p["paragraphs"])
    lk = F.slice(p["links"], 1, max_links)
    link_lines = F.when(F.size(p["links"]) > 0, F.concat(
        F.array(F.lit(RENDER_LABELS["links"])),
        F.transform(lk, lambda l: F.concat(F.substring(l["text"], 1, LINK_TEXT_CHARS), F.lit(" -> "), l["href"])))) \
        .otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(head, hs, body, link_lines), "\n")


def render_text(df: DataFrame, key: str = "page_id", url: str = "url", parsed: str = "parsed") -> DataFrame:
    """W9 + S9 inputs: file name from the safe title (page_<id> when empty) and the rendering."""
    name = safe_name(page_title(parsed), F.concat(F.lit("page_"), F.col(key).cast("string")))
    return df.select(key, url, "html", name.alias("file_name"), render_text_column(url, parsed).alias("rendered"))


def page_route(dynamic: Column, login: Column) -> Column:
    """Login or dynamic pages go to the dynamic crawler, the rest to the static one."""
    return F.when(login | dynamic, F.lit("dynamic")).otherwise(F.lit("static"))
