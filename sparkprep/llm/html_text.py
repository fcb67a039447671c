"""Operator 3, main text of web pages with a suffix array for each host.

Markup decides first. A page is cut into blocks at block tags; text inside a
menu, header, footer, sidebar, notice, advert, form, comment section (by tag,
role, or a class or id that names just that) is *side* text, also where such an
element stands within a block; a block inside ``article`` or ``main`` is *main*
text, others are *open*. A page with text in ``main`` (or role main) gives its main text
only; beside an ``article``, which may be a teaser, open blocks are decided like
those of pages without main text.

Then repetition on a host decides. The tokens of a host's pages are concatenated
into one stream, with a separator of its own after each page, and their suffixes
sorted to a depth of ``REPEAT`` tokens by prefix doubling (a suffix array with its
runs of equal prefixes). A run with suffixes of many pages is a long repeated
substring. Pages with the same text count once.

* *Main text* of every page goes through one array. A main block falls if runs that
  ``SHARE`` of the host's different main texts have, of ``TEXTS`` at least, cover all
  of it: a notice of the site that stands inside the article. Lines that fewer
  articles share stay, and so does a page of which such runs cover more than half:
  it is a mirror or near copy of other pages.
* *Side and open text* goes through another, on hosts that have open blocks to
  decide. Tokens that runs of ``PAGES`` pages cover are boilerplate. So is a whole
  block that as many pages have, of any length. An open block keeps its unique runs.

A host may have a third of all pages, so its pages are dealt to groups, each with
its own array. Of main text, a run that has its share of all texts has it in one
group at least; those are counted over all pages of the host. Of side and open
text, windows that are not repeated often enough inside their group (of about
``GROUP_TOKENS`` tokens) go on, as digests, to one comparison across all.

Defined results: null html is empty and gives empty text; a page without url
belongs to the host ''; rows that repeat page_id, url and html are all returned;
a page alone on its host keeps its open blocks whole; an empty table gives no
rows; a page of any length is parsed in one pass whose time grows with the
length, however its tags are nested (and twice in all, as texts that
are written and shuffled too are more disk than the input); further columns are not looked at."""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import bounded_batches, exact, slices, strings

#: Tokens of a long repeated substring, and the pages that must have it.
REPEAT = 12
PAGES = 3
GROUP_TOKENS = 20_000
#: A main block falls by what three of four main texts of a host have, if it has so many different ones.
SHARE = (3, 4)
TEXTS = 10
#: Different main texts of a group, fewer (but ``GROUP_LEAST``) if it would have more than ``GROUP_MOST`` tokens.
GROUP_TEXTS = 64
GROUP_LEAST = 16
GROUP_MOST = 400_000
MAIN, OPEN, SIDE = 2, 0, 1
WHOLE = 3  # inside the main element, which has a page's main text whole

#: Comments, and elements whose content is not markup: a tag inside them is none.
NO_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
TAG = re.compile(r"""<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"<]*"|'[^'<]*'|[^'"<>])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""")
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
ROLE_MAIN = re.compile(r"""\brole\s*=\s*["']?main\b""", re.I)
# Names of the HTML language and words of common class names.
UNSEEN = frozenset("script style noscript template svg iframe head title textarea select option object canvas audio video math".split())
SIDE_TAGS = frozenset("nav header footer aside form menu dialog button label fieldset".split())
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td
    tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SCOPES = frozenset("article main section div td th table aside nav header footer form body li ul ol blockquote".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog form alert menu menubar".split())
SIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies
    consent notice notices newsletter subscribe subscription signup login sidebar side menu nav navbar navigation breadcrumb
    breadcrumbs footer header masthead comment comments reply replies disqus share sharing social related recommended widget
    popup modal overlay toolbar pagination pager skip""".split())
#: The whole name must be of side words and these: share-buttons is side text, related-work and has-sidebar are not.
COMPANIONS = frozenset("""area articles bar block box button buttons container form icon icons item items link links list panel posts
    section slot thread unit wrapper""".split())
#: An id of these names what they tell, not what they are.
NAMED = frozenset("section h1 h2 h3 h4 h5 h6".split())


def _side(name: str, attributes: str, in_main: bool) -> bool:
    if name in SIDE_TAGS:
        # The header of an article has its title.
        return not (name == "header" and in_main)
    if not attributes or name in ("html", "body"):
        return False
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in SIDE_ROLES:
            return True
        if key == "class" or key == "id" and name not in NAMED:
            for one in value.split():
                words = set(re.findall("[a-z]+", one))
                # Inside the main text a header is the text's own.
                if words & SIDE_WORDS - ({"header"} if in_main else set()) and not words - SIDE_WORDS - COMPANIONS:
                    return name not in ("article", "main") or "comment" in value
    return False


class _Open:
    """The open elements. Counts of their names, since the last article or main
    and since the last scope, tell whether a search would find one, so a search
    costs no more than the elements it takes away."""

    def __init__(self):
        self.stack: list[tuple[str, bool, int, bool]] = []  # name, side, main, unseen
        self.all: Counter = Counter()
        self.in_main: list[Counter] = [Counter()]
        self.in_scope: list[Counter] = [Counter()]
        self.scopes: list[str] = []

    @property
    def state(self) -> tuple[bool, int, bool]:
        return self.stack[-1][1:] if self.stack else (False, OPEN, False)

    def push(self, name: str, side: bool, main: int, unseen: bool) -> None:
        self.stack.append((name, side, main, unseen))
        for counts in (self.all, self.in_main[-1], self.in_scope[-1]):
            counts[name] += 1
        if name in ("article", "main"):
            self.in_main.append(Counter())
        if name in SCOPES:
            self.in_scope.append(Counter())
            self.scopes.append(name)

    def pop_to(self, name: str) -> None:
        """Closes the last element of a name that is known to be open, and all in it."""
        last = None
        while last != name:
            last = self.stack.pop()[0]
            if last in SCOPES:
                self.in_scope.pop()
                self.scopes.pop()
            if last in ("article", "main"):
                self.in_main.pop()
            for counts in (self.all, self.in_main[-1], self.in_scope[-1]):
                counts[last] -= 1

    def close(self, name: str) -> None:
        # Only a scope's end tag reaches out of an article or main.
        if (self.all if name in SCOPES else self.in_main[-1])[name]:
            self.pop_to(name)

    def implied_end(self, name: str) -> None:
        """An open element of the kind ends here, unless a scope lies between."""
        if self.in_scope[-1][name] or self.scopes[-1:] == [name]:
            self.pop_to(name)


def blocks(page: str) -> list[tuple[int, str]]:
    """(kind, text) of each block in page order; what is never shown is left out."""
    out: list[tuple[int, str]] = []
    opened = _Open()
    side, main, unseen = opened.state
    own: list[str] = []     # the block's text
    beside: list[str] = []  # text of side elements that stand in it

    def flush():
        for kind, buffer in ((main, own), (SIDE, beside)):
            if buffer:
                text = " ".join(entities.unescape("".join(buffer)).split())
                buffer.clear()
                if text:
                    out.append((kind, text))

    def shown(text):
        if not unseen:
            (beside if side else own).append(text)

    page, at = NO_MARKUP.sub("", page), 0
    for m in TAG.finditer(page):
        close, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        name = (name or "").lower()
        if m.start() > at:
            shown(page[at : m.start()])
        at = m.end()
        if not name:
            continue
        if name in BLOCK_TAGS:
            flush()
        elif name == "br":
            shown(" ")
        if close:
            opened.close(name)
        elif name not in VOID and not (attributes.endswith("/") and name not in BLOCK_TAGS):
            if name in ("p", "li", "td", "th", "tr", "dd", "dt", "option"):
                opened.implied_end(name)
            side, main, unseen = opened.state
            if name == "main" or ROLE_MAIN.search(attributes):
                flush()
                main, side = WHOLE, False
            main = main or (MAIN if name == "article" else OPEN)
            beside.append(" ")  # texts of side elements are apart
            opened.push(name, side or _side(name, attributes, main != OPEN), main, unseen or name in UNSEEN)
        state = opened.state
        if state[1] != main:
            flush()
        side, main, unseen = state
    if at < len(page):
        shown(page[at:])
    flush()
    return out


def _with_host(pages: DataFrame) -> DataFrame:
    authority = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(F.coalesce(authority, F.lit("")), r"^.*@", ""), r":[0-9]*$", ""))
    return pages.withColumn("host", host)


def _decided(found: list[tuple[int, str]]) -> bool:
    """Markup alone decides the page: no open block may be main text."""
    kinds = {k for k, _ in found}
    return WHOLE in kinds or MAIN in kinds and OPEN not in kinds


def _parsed(pages: DataFrame, kind: str) -> DataFrame:
    """The blocks of every page, and whether markup alone decides it."""

    def task(batches):
        import pyarrow as pa

        for piece in slices(batches, text_col="html"):
            found = [blocks(p) for p in strings(piece.column("html"))]
            yield pa.RecordBatch.from_arrays(
                [*[piece.column(c) for c in ("page_id", "url", "host")], pa.array([_decided(b) for b in found]),
                 pa.array([[k for k, _ in b] for b in found], pa.list_(pa.int32())),
                 pa.array([[t for _, t in b] for b in found], pa.list_(pa.string()))],
                ["page_id", "url", "host", "decided", "kinds", "texts"])

    return pages.mapInArrow(task, f"page_id {kind}, url string, host string, decided boolean, kinds array<int>, texts array<string>")


def _main_streams(pages: DataFrame) -> DataFrame:
    """(host, stream, open): the main text of every page, and whether open blocks are to be decided."""

    def task(batches):
        import pyarrow as pa

        for piece in slices(batches, text_col="html"):
            found = [blocks(p) for p in strings(piece.column("html"))]
            yield pa.RecordBatch.from_arrays(
                [piece.column("host"), pa.array([" ".join(t for k, t in b if k >= MAIN) for b in found], pa.string()),
                 pa.array([any(k == OPEN for k, _ in b) and not _decided(b) for b in found])], ["host", "stream", "open"])

    return pages.select("host", "html").mapInArrow(task, "host string, stream string, open boolean")


def suffix_runs(ids: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each suffix by its first ``depth`` tokens, by prefix doubling;
    equal ranks are equal prefixes. The stream ends with ``depth`` separators."""
    n = len(ids) - depth
    ranks, have = {1: np.unique(ids, return_inverse=True)[1]}, 1
    while have * 2 <= depth:
        r = ranks[have]
        ranks[have * 2] = np.unique(r[: len(r) - have] * (r.max() + 1) + r[have:], return_inverse=True)[1]
        have *= 2
    rank, left = ranks[have], depth - have
    while left:
        step = 1 << (left.bit_length() - 1)
        more = ranks[step][depth - left :]
        size = min(len(rank), len(more))
        rank = np.unique(rank[:size] * (more.max() + 1) + more[:size], return_inverse=True)[1]
        left -= step
    return rank[:n]


def _window_runs(streams: list[list[str]]):
    """The windows of pages' tokens in the order of the suffix array: page, place
    in it, whether a run of equal windows begins, whether the page's first window
    of its run, and the pages of its run."""
    number: dict[str, int] = {}
    parts, owner = [], []
    for p, tokens in enumerate(streams):
        parts.append(np.fromiter((number.setdefault(t, len(number)) for t in tokens), np.int64, len(tokens)))
        parts.append(np.array([-1 - p]))  # no window reaches over a page's end
        owner.append(np.full(len(tokens) + 1, p))
    ids, owner = np.concatenate(parts + [np.full(REPEAT, -1 - len(streams))]), np.concatenate(owner)
    inner = np.ones(len(owner), bool)
    ends = np.flatnonzero(ids[: len(owner)] < 0)
    for k in range(REPEAT):
        inner[np.maximum(ends - k, 0)] = False
    first = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    rank = suffix_runs(ids, REPEAT)
    order = np.argsort(rank, kind="stable")  # the suffix array, to the depth; a run's pages ascend
    order = order[inner[order]]
    if not len(order):
        return (np.zeros(0, np.int64),) * 5
    begins = np.r_[True, rank[order][1:] != rank[order][:-1]]
    run, pages = np.flatnonzero(begins), owner[order]
    counts = begins | np.r_[True, pages[1:] != pages[:-1]]
    n = np.add.reduceat(counts.astype(np.int64), run)
    return pages, order - first[pages], begins, counts, np.repeat(n, np.diff(np.r_[run, len(order)]))


def _group_windows(table):
    """Of one group of pages: for each page the starts of windows that enough
    pages of the group have, and starts, digests and weights (pages) of the
    windows to compare with other groups: those that fewer pages have, and one
    of each run that has enough."""
    import pyarrow as pa

    rids, streams = table.column("rid").to_pylist(), []
    for texts in table.column("texts").to_pylist():
        streams.append(" ".join(texts).split(" ") if texts else [])
    again, alone, weight = [[] for _ in streams], [[] for _ in streams], [[] for _ in streams]
    pages, place, begins, counts, n = _window_runs(streams)
    if len(pages):
        for p, i, often, new, counted, many in zip(pages.tolist(), place.tolist(), (n >= PAGES).tolist(), begins.tolist(), counts.tolist(), n.tolist()):
            if often:
                again[p].append(i)
                if new:  # speaks for its run in other groups
                    alone[p].append(i)
                    weight[p].append(many)
            else:
                alone[p].append(i)
                weight[p].append(int(counted))
    digest = lambda p, i: hashlib.md5(" ".join(streams[p][i : i + REPEAT]).encode()).digest()
    return pa.table({
        "host": table.column("host"), "rid": table.column("rid"),
        "again": pa.array(again, pa.list_(pa.int32())), "alone": pa.array(alone, pa.list_(pa.int32())),
        "weight": pa.array(weight, pa.list_(pa.int32())),
        "digests": pa.array([[digest(p, i) for i in a] for p, a in enumerate(alone)], pa.list_(pa.binary()))})


def _often(n, of):
    return n * SHARE[1] >= of * SHARE[0]


def _group_shares(batches):
    """Of each group of main texts: how many there are, and the windows that enough
    of them have; none if it is its host's only group and has too few texts."""
    import pyarrow as pa

    for batch in batches:
        hosts, opens, parts = (batch.column(c).to_pylist() for c in ("host", "open", "groups"))
        for host, opened, several, group in zip(hosts, opens, parts, batch.column("streams")):
            streams = [t.split(" ") for t in group.as_py() if t]
            windows = []
            if len(streams) >= (1 if several > 1 else TEXTS):
                pages, place, begins, _, n = _window_runs(streams)
                at = np.flatnonzero(begins & _often(n, len(streams))) if len(pages) else pages
                windows = [" ".join(streams[p][i : i + REPEAT]) for p, i in zip(pages[at].tolist(), place[at].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([host], pa.string()), pa.array([len(streams)], pa.int64()), pa.array([opened]), pa.array([windows], pa.list_(pa.string()))],
                ["host", "n", "open", "windows"])


def _arrays(streams: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, n, open, windows) of each group; ``hosts`` has the groups of each host."""
    dealt = streams.join(hosts, "host").withColumn("part", F.pmod(F.xxhash64("stream"), F.greatest("groups", F.lit(1))))
    # Equal texts of a host once: they are in one group, and few are left of many copies.
    groups = dealt.groupBy("host", "part").agg(F.collect_set("stream").alias("streams"), F.max("open").alias("open"), F.max("groups").alias("groups"))
    return materialize(groups.select("host", "streams", "open", "groups").mapInArrow(
        _group_shares, "host string, n bigint, open boolean, windows array<string>"))


def _hits(batches):
    """Which of its host's windows a page's main text has."""
    import pyarrow as pa

    for piece in slices(batches, text_col="stream"):
        known, out = {}, []
        for k, (host, stream) in enumerate(zip(piece.column("host").to_pylist(), piece.column("stream").to_pylist())):
            if host not in known:
                known[host] = _by_head({w: i for i, w in enumerate(piece.column("windows")[k].as_py())})
            out.append(sorted({known[host][w] for _, w in _found(stream.split(" "), known[host])}))
        yield pa.RecordBatch.from_arrays([piece.column("host"), piece.column("stream"), pa.array(out, pa.list_(pa.int32()))], ["host", "stream", "hits"])


def _by_head(windows: dict) -> dict:
    """Windows with what is known of them, and each one's first token (with None), which no window equals."""
    return {**{w.split(" ", 1)[0]: None for w in windows}, **windows}


def _found(tokens: list[str], windows: dict):
    """(place, window) of the windows among the tokens."""
    for i in range(len(tokens) - REPEAT + 1):
        if tokens[i] in windows:
            window = " ".join(tokens[i : i + REPEAT])
            if window in windows:
                yield i, window


def common_windows(pages: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """(host, windows): the windows that enough of a host's different main texts
    have, and (host) of the hosts with open blocks to decide; None if there are none."""
    streams = _main_streams(pages)
    sized = pages.groupBy("host").agg(F.approx_count_distinct(F.xxhash64("html")).alias("n"), F.avg(F.length("html")).alias("size"))
    fit = F.greatest(F.lit(GROUP_LEAST), F.least(F.lit(GROUP_TEXTS), F.floor(GROUP_MOST * 6 / F.greatest("size", F.lit(1.0)))))
    # Written, so that Spark can split a hot host's side of the join.
    found = _arrays(streams, materialize(sized.select("host", F.ceil(F.col("n") / F.coalesce(fit, F.lit(1))).alias("groups"))))
    totals = materialize(found.groupBy("host").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"), F.max("open").alias("open")))
    asked = totals.where("open").select("host")
    # Pages that differ, but not in their main text, make groups of few texts: dealt again by the texts' number.
    sparse = totals.where((F.col("n") >= TEXTS) & (F.col("parts") > 1) & (F.col("n") < F.col("parts") * TEXTS))
    if not sparse.isEmpty():
        again = materialize(sparse.select("host", F.ceil(F.col("n") / GROUP_TEXTS).alias("groups")))
        found = found.join(again, "host", "left_anti").unionByName(_arrays(streams.join(again.select("host"), "host", "left_semi"), again))
        totals = found.groupBy("host").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"))
    maybe = found.join(totals.where(F.col("n") >= TEXTS).select("host", F.col("n").alias("texts"), "parts"), "host")
    maybe = materialize(maybe.select("host", "texts", "parts", F.explode("windows").alias("window")).distinct())
    asked = None if asked.isEmpty() else asked
    if maybe.isEmpty():
        return None, asked
    # The only group of a host knows; windows of others are counted over all pages.
    sure = maybe.where("parts = 1").groupBy("host").agg(F.sort_array(F.collect_list("window")).alias("windows"))
    several = materialize(maybe.where("parts > 1").groupBy("host", "texts").agg(F.sort_array(F.collect_list("window")).alias("windows")))
    if not several.isEmpty():
        each = streams.join(several.select("host", "windows"), "host").select("host", "stream", "windows")
        each = each.mapInArrow(_hits, "host string, stream string, hits array<int>").where("size(hits) > 0")
        each = each.groupBy("host", F.md5("stream").alias("text")).agg(F.first("hits").alias("hits"))
        n = each.select("host", F.explode("hits").alias("hit")).groupBy("host", "hit").agg(F.count(F.lit(1)).alias("n"))
        counted = n.join(several, "host").where(_often(F.col("n"), F.col("texts")))
        counted = counted.select("host", F.element_at("windows", F.col("hit") + 1).alias("window"))
        sure = sure.unionByName(counted.groupBy("host").agg(F.sort_array(F.collect_list("window")).alias("windows")))
    return materialize(sure), asked


def _staying(texts: list[str], windows: dict) -> list[bool]:
    """Of main blocks, whether each stays: a host's common windows don't cover all of it."""
    if not windows:
        return [True] * len(texts)
    tokens = [t.split(" ") for t in texts]
    stream = [t for block in tokens for t in block]
    covered = np.zeros(len(stream), bool)
    for i, _ in _found(stream, windows):
        covered[i : i + REPEAT] = True
    if covered.sum() * 2 > len(stream):
        return [True] * len(texts)
    ends = np.cumsum([0] + [len(t) for t in tokens]).tolist()
    return [not covered[i:j].all() for i, j in zip(ends, ends[1:])]


def _known(batch) -> dict:
    """The common windows of a batch's hosts."""
    known: dict = {}
    for k, host in enumerate(batch.column("host").to_pylist()):
        if host not in known:
            known[host] = _by_head(dict.fromkeys(batch.column("windows")[k].as_py() or (), True))
    return known


def _with_windows(rows: DataFrame, common: DataFrame | None) -> DataFrame:
    if common is None:
        return rows.withColumn("windows", F.lit(None).cast("array<string>"))
    return rows.join(common, "host", "left")


def _main_texts(batches):
    """page_id, url, text of pages that markup and their hosts' common windows decide."""
    import pyarrow as pa

    for piece in slices(batches, text_col="html"):
        known = _known(piece)
        found = [[t for k, t in blocks(p) if k >= MAIN] for p in strings(piece.column("html"))]
        out = ["\n\n".join(t for t, stays in zip(b, _staying(b, known[h])) if stays) for b, h in zip(found, piece.column("host").to_pylist())]
        yield pa.RecordBatch.from_arrays([piece.column("page_id"), piece.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])


def _unmarked(rows: DataFrame) -> DataFrame:
    """Each different page text once: host, rid and its side and open blocks."""
    own = F.transform(F.filter(F.arrays_zip("kinds", "texts"), lambda b: b["kinds"] < MAIN), lambda b: b["texts"])
    return rows.select("host", "rid", own.alias("texts")).groupBy("host", "rid").agg(F.first("texts").alias("texts"))


def repeated_windows(texts: DataFrame) -> DataFrame:
    """(host, rid, start): the windows of a page that enough pages of its host have."""
    sized = texts.withColumn("n", F.aggregate("texts", F.lit(0).cast("long"), lambda s, t: s + F.length(t)) / 6)
    # Written, so that Spark can split a hot host's side of the join.
    hosts = materialize(sized.groupBy("host").agg(F.ceil(F.sum("n") / GROUP_TOKENS).alias("groups")))
    dealt = sized.join(hosts, "host").withColumn("part", F.pmod(F.xxhash64("rid"), F.greatest("groups", F.lit(1))))
    found = materialize(dealt.select("host", "part", "rid", "texts").groupBy("host", "part").applyInArrow(
        _group_windows, "host string, rid string, again array<int>, alone array<int>, weight array<int>, digests array<binary>"))
    alone = found.select("host", "rid", F.explode(F.arrays_zip("alone", "weight", "digests")).alias("w"))
    alone = alone.select("host", "rid", F.col("w.alone").alias("start"), F.col("w.weight").alias("weight"), F.col("w.digests").alias("digest"))
    across = materialize(alone.groupBy("host", "digest").agg(F.sum("weight").alias("pages")).where(F.col("pages") >= PAGES))
    far = alone.join(across.select("host", "digest"), ["host", "digest"]).select("host", "rid", "start")
    return far.unionByName(found.select("host", "rid", F.explode("again").alias("start")))


def repeated_blocks(texts: DataFrame) -> DataFrame:
    """(host, rid, places): the blocks of a page that enough pages of its host have whole."""
    each = texts.select("host", "rid", F.posexplode("texts").alias("place", "block")).withColumn("block", F.md5("block"))
    pages = each.select("host", "block", "rid").distinct().groupBy("host", "block").agg(F.count(F.lit(1)).alias("pages"))
    often = materialize(pages.where(F.col("pages") >= PAGES).select("host", "block"))
    return each.join(often, ["host", "block"]).groupBy("host", "rid").agg(F.collect_set("place").alias("places"))


def _unique_runs(batches):
    import pyarrow as pa

    for batch in batches:
        out, known = [], _known(batch)
        for host, kinds, texts, starts, places in zip(*(batch.column(c).to_pylist() for c in ("host", "kinds", "texts", "starts", "places"))):
            stays = iter(_staying([t for k, t in zip(kinds, texts) if k >= MAIN], known[host]))
            tokens = [t.split(" ") for t in texts]
            covered = np.zeros(sum(len(t) for k, t in zip(kinds, tokens) if k < MAIN) + REPEAT, bool)
            for s in starts or ():
                covered[s : s + REPEAT] = True
            whole, at, n, kept = set(places or ()), 0, 0, []
            for kind, block in zip(kinds, tokens):
                if kind >= MAIN:
                    if next(stays):
                        kept.append(" ".join(block))
                    continue
                rest = [] if n in whole else [t for t, c in zip(block, covered[at : at + len(block)]) if not c]
                at, n = at + len(block), n + 1
                if kind == OPEN and rest:
                    kept.append(" ".join(rest))
            out.append("\n\n".join(kept))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())],
                                         ["page_id", "url", "text"])


def extract_main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for each row."""
    bounded_batches(df)
    pages = _with_host(exact(df, page_id=id_col, url=url_col, html=html_col))
    kind = pages.schema["page_id"].dataType.simpleString()
    common, some = common_windows(pages)
    rows = f"page_id {kind}, url string, text string"
    if some is None:
        found = _with_windows(pages, common).select("page_id", "url", "host", "html", "windows").mapInArrow(_main_texts, rows)
        return found.withColumn("n_chars", F.length("text").cast("long"))
    rest = _with_windows(pages.join(some, "host", "left_anti"), common)
    found = rest.select("page_id", "url", "host", "html", "windows").mapInArrow(_main_texts, rows)
    parsed = materialize(_parsed(pages.join(some, "host", "left_semi").select("page_id", "url", "html", "host"), kind))
    decided = F.filter(F.arrays_zip("kinds", "texts"), lambda b: b["kinds"] >= MAIN)
    decided = parsed.where("decided").withColumns({"kinds": F.transform(decided, lambda b: b["kinds"]), "texts": F.transform(decided, lambda b: b["texts"])})
    decided = decided.withColumns({"starts": F.lit(None).cast("array<int>"), "places": F.lit(None).cast("array<int>")})

    # Open blocks are decided by what the pages of their host repeat.
    named = parsed.withColumn("rid", F.md5(F.concat(F.array_join("kinds", ""), F.lit(":"), F.array_join(F.transform("texts", lambda t: F.md5(t)), ""))))
    undecided = named.where("NOT decided")
    asked = materialize(undecided.select("host", "rid").distinct())
    texts = materialize(_unmarked(named.join(asked.select("host").distinct(), "host", "left_semi")))
    starts = repeated_windows(texts).join(asked, ["host", "rid"], "left_semi").groupBy("host", "rid").agg(F.collect_set("start").alias("starts"))
    whole = repeated_blocks(texts).join(asked, ["host", "rid"], "left_semi")
    ready = undecided.join(starts, ["host", "rid"], "left").join(whole, ["host", "rid"], "left")
    judged = [_with_windows(r, common).select("page_id", "url", "host", "kinds", "texts", "starts", "places", "windows").mapInArrow(_unique_runs, rows)
              for r in (decided, ready)]
    return found.unionByName(judged[0]).unionByName(judged[1]).withColumn("n_chars", F.length("text").cast("long"))
