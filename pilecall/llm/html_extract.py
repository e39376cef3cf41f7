"""Main text of web pages by consensus host paths.

Pass one scores every container of a page by the text that its blocks hold (link
text counts against it, text of inner containers counts less) and lets the page vote with the best container's generalised
path: tags and classes from the root, numbers replaced. Spark sums the votes per host
and path. Pass two extracts every page again from the containers at the host's winning
path; a page without such a container uses its own best one, a page without any
container its whole body. Menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments are left out by tag, role and class names.

Edge cases: a null or empty page has the empty text; a null url is the host ``null``;
unclosed and stray tags are repaired as browsers do for blocks; an unclosed comment,
script or style ends the page; repeated rows repeat their votes and results; extra
columns are ignored.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, written

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article body div main section td".split())
LEFT_OUT_TAGS = frozenset("aside button dialog fieldset footer form head header iframe input menu nav noscript script select style svg template textarea".split())
LEFT_OUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
LEFT_OUT_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment commentlist comments consent cookie cookies "
    "copyright dfp disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices "
    "notification pager pagination paywall popup promo promoted promotion related reader replies respond share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
CLOSED_BY = {  # a start tag of the value's names ends an open element of the key's
    "p": BLOCKS - {"caption", "col"},
    "li": frozenset({"li"}),
    "dd": frozenset({"dd", "dt"}),
    "dt": frozenset({"dd", "dt"}),
    "option": frozenset({"option", "optgroup"}),
    "tr": frozenset({"tr", "tbody", "tfoot", "thead"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
}
BOUNDARY = frozenset("article aside body div footer form header html main nav ol section table td th ul".split())

TOKEN = re.compile(r"<!--|<!\[CDATA\[|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
DEEPEST = 100  # containers inside each other; deeper ones count as part of the last
NUMBER = re.compile(r"\d+")


@dataclass
class Container:
    path: str
    left_out: bool
    score: float = 0.0
    blocks: list[str] = field(default_factory=list)  # of this element and those below, in page order


def attributes(text: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(text)} if "=" in text else {}


def names(value: str) -> list[str]:
    """The words of class and id names: ``ad-box topMenu`` gives ad, box, top, menu."""
    return [w.lower() for w in re.split(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])", value) if w]


def left_out(tag: str, attrs: dict[str, str]) -> bool:
    """Whether an element with these attributes isn't part of an article."""
    if tag in LEFT_OUT_TAGS or attrs.get("role", "").lower() in LEFT_OUT_ROLES or "hidden" in attrs:
        return tag != "body"
    if tag in ("html", "body", "main", "article") or not (attrs.get("class") or attrs.get("id")):
        return False
    return not LEFT_OUT_WORDS.isdisjoint(names(attrs.get("class", "") + " " + attrs.get("id", "")))


def step_of(tag: str, attrs: dict[str, str]) -> str:
    """An element's step in a generalised path."""
    classes = sorted({NUMBER.sub("#", c) for c in attrs.get("class", "").split()})
    return ".".join([tag, *classes])


def containers(page: str | None) -> list[Container]:
    """Containers of a page in page order, each with the blocks of its kept text and its own score."""
    page = page or ""
    root = Container("", False)
    found = [root]
    # open elements: (tag, innermost container, all open containers, left out, is a link)
    stack: list[tuple[str, Container, tuple[Container, ...], bool, bool]] = [("", root, (root,), False, False)]
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        block = " ".join("".join(text).split())
        if block:
            around = stack[-1][2]
            for c in around:
                c.blocks.append(block)
            worth = len(block) - 2 * linked + (20 if len(block) > 40 else 0)
            for c in reversed(around):  # an outer container gains less from what an inner one holds
                c.score += worth
                worth *= 0.8
        text.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not stack[-1][3]:
            piece = html.unescape(raw)
            text.append(piece)
            if stack[-1][4]:
                linked += len(piece)

    def close(depth: int) -> None:
        """Close the open elements from ``depth`` on."""
        if any(e[0] in BLOCKS for e in stack[depth:]):
            flush()
        del stack[depth:]

    at = 0
    while m := TOKEN.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0] == "<!--":
                end = page.find("-->", at)
                at = len(page) if end < 0 else end + 3
            continue
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
                if stack[depth][0] in BOUNDARY and tag not in BOUNDARY:
                    break
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(page, at)
            if not m[3].endswith("/"):
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            text.append(" ")
            continue
        for depth in range(len(stack) - 1, 0, -1):
            if tag in CLOSED_BY.get(stack[depth][0], ()):
                close(depth)
                break
            if stack[depth][0] in BOUNDARY:
                break
        if tag in BLOCKS:
            flush()
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        attrs = attributes(m[3])
        _, inner, around, out, link = stack[-1]
        out = out or left_out(tag, attrs)
        if tag in CONTAINERS and not out and len(around) < DEEPEST:
            inner = Container(f"{inner.path}>{step_of(tag, attrs)}" if inner.path else step_of(tag, attrs), out)
            found.append(inner)
            around = (*around, inner)
        stack.append((tag, inner, around, out, link or tag == "a"))
    add(page[at:])
    close(1)
    flush()
    return found


def vote_of(page: str | None) -> tuple[str, float] | None:
    """The path and score of a page's best container."""
    best = max((c for c in containers(page) if c.path and c.score > 0), key=lambda c: c.score, default=None)
    return (best.path, best.score) if best else None


def text_at(page: str | None, path: str | None) -> str:
    """A page's text from the outermost containers at ``path``, from its best one, or from all of it."""
    found = containers(page)
    chosen = [c for c in found if c.path and c.path == path and c.blocks]
    if not chosen:
        chosen = [max(found[1:], key=lambda c: c.score, default=found[0])]
        if chosen[0].score <= 0:
            chosen = found[:1]
    return "\n".join(b for c in chosen for b in c.blocks)


def host_of(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit("null"))


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path: the path with the largest sum of votes in each host (the first by name on a tie)."""

    def run(batches):
        for batch in slices(batches):
            votes = [vote_of(h) for h in batch.column("html").to_pylist()]
            kept = [i for i, v in enumerate(votes) if v]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host").take(pa.array(kept, pa.int64())), pa.array([votes[i][0] for i in kept], pa.string()), pa.array([votes[i][1] for i in kept], pa.float64())],
                names=["host", "path", "score"],
            )

    votes = pages.select(host_of("url").alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(run, "host string, path string, score double")
    # a page's vote weighs as the logarithm of its text, so that one long page doesn't outvote a host
    sums = votes.groupBy("host", "path").agg(F.sum(F.log1p("score")).alias("weight"))
    best = sums.groupBy("host").agg(F.max("weight").alias("most"))
    tied = sums.join(best, "host").where("weight >= most - 1e-9")
    return written(tied.groupBy("host").agg(F.min("path").alias("path")), "host-paths")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per page."""
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of("url").alias("host"))
    rows = rows.join(host_paths(pages), "host", "left").select("page_id", "url", "html", "path")

    def run(batches):
        for batch in slices(batches):
            texts = [text_at(h, p) for h, p in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    page_id = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {page_id}, url string, text string, n_chars bigint")
