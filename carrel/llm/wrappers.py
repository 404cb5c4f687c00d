"""HTML extraction by wrappers: union-free regular expressions over the pages of a host.

A page is a stream of block tags and text. Its shape keeps tags (with their
classes, ids and roles) and replaces texts by slots; neighbours that repeat are
folded into repeated groups. The shapes of a host are aligned one after
another: equal tags are matched, what only one side has becomes optional,
what stands side by side again becomes repeated, texts become slots. The
result, a regular expression without alternatives, is the host's wrapper; its
marks tell regions that repeat (lists) from the one that holds an article, and
what varies over the pages from what does not; names of elements decide where
these leave a choice. Every page is read with what its host's wrapper tells.
"""

import html
import json
import re
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from carrel.llm.common import share_of, stage

RAW = "script|style|noscript|template|svg|iframe|object|canvas|textarea|title"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z/][^<>]*\Z|[^<]+|<",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Names of HTML elements.
BLOCKS = frozenset(
    "html head body main article section nav aside header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead"
    " tbody tfoot tr td th caption blockquote pre figure figcaption form fieldset address details summary hr center"
    " select option button label dialog menu".split()
)
VOID = frozenset("hr br img input meta link area base col embed source track wbr".split())
ENDS_PARAGRAPH = BLOCKS - frozenset("label button select option caption summary".split())
#: Elements that end each other, up to the element that holds them.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"})}
SIBLINGS |= {"dd": SIBLINGS["dt"], "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"}), "option": ({"option"}, {"select"})}
REST_TAGS = frozenset("head nav header footer aside menu select option button dialog address".split())
#: Elements that are rest unless the article is inside of them.
HOLDERS = frozenset("form fieldset label".split())
MAIN_TAGS = ("article", "main")
#: Words in classes, ids and roles of what is not the article.
REST_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner banners nav navbar"
    " navigation menu menus sidebar aside footer header masthead topbar breadcrumb breadcrumbs cookie cookies consent"
    " notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social"
    " related recommended comment comments commentlist reply replies respond disqus widget widgets pagination pager"
    " copyright toolbar search form complementary contentinfo".split()
)
MAIN_WORDS = frozenset("article content main post entry story articlebody".split())
#: Words that say how a page is laid out; what they stand with is not meant.
LAYOUT_WORDS = frozenset("with has no without hide show".split())
#: Words that go with those above and change nothing.
NEUTRAL_WORDS = frozenset(
    "list box bar block wrap wrapper container section area item items link links button buttons icon icons top bottom"
    " left right side site page post entry inner outer body text head title row col column group set".split()
)


@dataclass
class Node:
    """An element or, with the tag ``#``, a text slot; ``mark`` is one of ``""``, ``?``, ``+``, ``*``."""

    tag: str
    mark: str = ""
    parts: list = field(default_factory=list)

    def plain(self):
        return [self.tag, self.mark, [p.plain() for p in self.parts]]


def restored(plain):
    return Node(plain[0], plain[1], [restored(p) for p in plain[2]])


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _label(name, attributes):
    words = []
    for _, a, b, c in ATTRIBUTE.findall(attributes):
        words += re.sub(r"\d+", "#", (a or b or c).lower()).split()
    return name + "".join(sorted({f".{w}" for w in words}))


def blocks_of(page):
    """The stream of a page: its text blocks as (path of labels, text), and its shape.

    White space within a block becomes one space; character references are
    decoded once; tags that don't start a block are left out, so text may go on
    across them. Unclosed elements end where their parent does.
    """
    root = Node("")
    stack, path, blocks, words = [("", root)], [""], [], []

    def flush():
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            blocks.append((path[-1], text))
            stack[-1][1].parts.append(Node("#"))

    def close(to):
        while len(stack) > to:
            stack.pop()
            path.pop()

    for m in TOKEN.finditer(page):
        part = m[0]
        if part[0] != "<" or part == "<":
            words.append(html.unescape(part))
            continue
        name = (m[3] or m[6] or "").lower()
        if name not in BLOCKS:
            if name in ("br", "img", "input") or (not name and m[1] is not None and m[1].lower() != "title"):
                words.append(" ")
            continue
        closing = (m[2] if m[3] else m[5]) == "/"
        flush()
        if closing:
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] == name:
                    close(at)
                    break
            continue
        if name in ENDS_PARAGRAPH and stack[-1][0] == "p":
            close(len(stack) - 1)
        if name in SIBLINGS:
            ended, holders = SIBLINGS[name]
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] in ended:
                    close(at)
                    break
                if stack[at][0] in holders:
                    break
        label = _label(name, m[4] if m[3] else m[7])
        node = Node(label)
        stack[-1][1].parts.append(node)
        if name not in VOID:
            stack.append((name, node))
            path.append(f"{path[-1]}/{label}")
    flush()
    return blocks, folded(root)


# Wrappers: folding repeats, aligning two expressions


def _loosest(a, b):
    many, maybe = "+" in (a + b) or "*" in (a + b), "?" in (a + b) or "*" in (a + b)
    return ("*" if maybe else "+") if many else ("?" if maybe else "")


def _alike(a, b):
    return len(a) == len(b) and all(x.tag == y.tag for x, y in zip(a, b))


def folded(node, longest=4):
    """The node with neighbours that repeat, alone or as a group of up to ``longest``, folded into one."""
    parts = [folded(p, longest) for p in node.parts]
    for period in range(1, longest + 1):
        out = []
        for part in parts:
            out.append(part)
            last, before = out[-period:], out[-2 * period : -period]
            if len(before) == period and _alike(last, before):
                merged = [merge(x, y) for x, y in zip(before, last)]
                del out[-2 * period :]
                # A group repeats as a whole: each of its members does.
                out += [Node(x.tag, _loosest(x.mark, "+"), x.parts) for x in merged]
        parts = out
    return Node(node.tag, node.mark, parts)


def merge(a, b):
    """One expression that matches what either does; both have the same tag."""
    return Node(a.tag, _loosest(a.mark, b.mark), aligned(a.parts, b.parts))


def aligned(a, b):
    """Two sequences as one: a longest common subsequence of tags is matched, the rest becomes optional."""
    if _alike(a, b):
        return [merge(x, y) for x, y in zip(a, b)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i].tag == b[j].tag else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i].tag == b[j].tag:
            out.append(merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append(Node(a[i].tag, _loosest(a[i].mark, "?"), a[i].parts))
            i += 1
        else:
            out.append(Node(b[j].tag, _loosest(b[j].mark, "?"), b[j].parts))
            j += 1
    return folded(Node("", "", out), 1).parts


def expression(node):
    """The wrapper as a readable regular expression."""
    inner = " ".join(expression(p) for p in node.parts)
    text = "#" if node.tag == "#" else f"<{node.tag}>{f' {inner} ' if inner else ''}</>" if node.tag else inner
    return f"({text}){node.mark}" if node.mark else text


def slots(node, path=""):
    """Paths that have a text slot in the wrapper, in order."""
    found = []
    for part in node.parts:
        if part.tag == "#":
            found.append(path)
        else:
            found += slots(part, f"{path}/{part.tag}")
    return list(dict.fromkeys(found))


def _parts(word):
    return [part for part in re.split(r"[-_#]+", word) if part]


def _named_rest(words, strict=False):
    """Whether classes, ids and roles name something other than the article; ``strict``: and nothing else."""
    for word in words:
        parts = _parts(word)
        if any(p in LAYOUT_WORDS for p in parts) or not any(p in REST_WORDS for p in parts):
            continue
        if not strict or all(p in REST_WORDS or p in NEUTRAL_WORDS for p in parts):
            return True
    return False


def _main(label):
    name, *words = label.split(".")
    return name in MAIN_TAGS or any(p in MAIN_WORDS for w in words for p in _parts(w))


def _core(label):
    """Whether a label names the article, and nothing besides."""
    return _main(label) and not _named_rest(label.split(".")[1:])


def _weak(label, inside):
    """Whether a label names something other than the article, by its names or as a form; a word made of main words
    only speaks against it. Within the article (``inside``) only names that say nothing else count."""
    name, *words = label.split(".")
    if name in MAIN_TAGS:
        return False
    if any(_parts(w) and all(p in MAIN_WORDS for p in _parts(w)) for w in words):
        return False
    return name in HOLDERS or _named_rest(words, strict=inside)


def lists(node, path=""):
    """Paths of elements named as main that repeat in the wrapper: a list of articles, and not the article."""
    found = []
    for part in node.parts:
        if part.tag != "#":
            own = f"{path}/{part.tag}"
            if part.mark in ("+", "*") and _main(part.tag):
                found.append(own)
            found += lists(part, own)
    return list(dict.fromkeys(found))


def _prefixes(path):
    at = path.find("/", 1)
    while at > 0:
        yield path[:at]
        at = path.find("/", at + 1)
    if path:
        yield path


def candidates(weights):
    """The paths of a page outside of what is named as something other than the article. ``weights``: length of the
    text on each path.

    What is named so but holds most of the text within articles is their
    surroundings, as are the page and its body.
    """
    core, under = 0, {}
    for path, weight in weights.items():
        labels = path.split("/")[1:]
        if any(x.split(".")[0] in REST_TAGS for x in labels) or not any(map(_core, labels)):
            continue
        core += weight
        for prefix in _prefixes(path):
            under[prefix] = under.get(prefix, 0) + weight
            if _core(prefix.rpartition("/")[2]):
                break  # what is inside of the article doesn't hold it
    kept = []
    for path in weights:
        inside = False
        for prefix in _prefixes(path):
            label = prefix.rpartition("/")[2]
            name = label.split(".")[0]
            if name in REST_TAGS:
                break
            if name not in ("html", "body") and _weak(label, inside) and 2 * under.get(prefix, 0) <= core:
                break
            inside = inside or _core(label)
        else:
            kept.append(path)
    return kept


def main_paths(weights, repeated=()):
    """The paths in the main region that the best rule finds: article, main, names; none if no rule finds one.

    The region holds a quarter of the text at least, or half of it where it is
    one of those that repeat.
    """
    whole, repeated = sum(weights.values()), set(repeated)
    for test in (lambda x: x.split(".")[0] == "article", lambda x: x.split(".")[0] == "main", _main):
        single, inside = [], []
        for path in weights:
            hits = [p for p in _prefixes(path) if test(p.rpartition("/")[2])]
            if hits:
                inside.append(path)
                if not repeated.issuperset(hits):
                    single.append(path)
        for region, share in ((single, 4), (inside, 2)):
            if region and share * sum(weights[p] for p in region) >= whole:
                return region
    return []


def _weights(blocks):
    out = {}
    for path, text in blocks:
        out[path] = out.get(path, 0) + len(text)
    return out


def block_key(path, text):
    """A hash of a block and its place, as a long."""
    return xxhash.xxh64_intdigest(f"{path}\0{text}".encode("utf-8", "replace")) - 2**63


def content_of(blocks, repeated=(), fixed=()):
    """The texts of a page's article: its own main region is chosen, so pages of other templates don't matter.
    ``repeated`` are paths of lists, ``fixed`` keys of blocks that are left out of pages without a main region."""
    weights, fixed = _weights(blocks), set(fixed)
    wanted = {path: weights[path] for path in candidates(weights)}
    kept = set(main_paths(wanted, repeated))
    if kept:
        return [text for path, text in blocks if path in kept]
    return [text for path, text in blocks if path in wanted and not (fixed and block_key(path, text) in fixed)]


# Spark


_SHAPE = pa.struct(
    [("shape", pa.string()), ("page", pa.int64()), ("paths", pa.list_(pa.string())), ("texts", pa.list_(pa.list_(pa.int64())))]
)


def _shapes(pages, text):
    @F.arrow_udf("struct<shape:string,page:long,paths:array<string>,texts:array<array<long>>>")
    def shape_of(htmls: pa.Array) -> pa.Array:
        rows = []
        for page in htmls.to_pylist():
            blocks, shape = blocks_of(page)
            # Only blocks that may be left out: not named as rest, not in the main region.
            weights = _weights(blocks)
            own = {p: weights[p] for p in candidates(weights)}
            inside = set(main_paths(own))
            keys = {p: set() for p in own if p not in inside}
            for path, block in blocks:
                if path in keys:
                    keys[path].add(block_key(path, block))
            whole = block_key("", "\0".join(f"{path}\0{block}" for path, block in blocks))
            texts = [sorted(k) for k in keys.values()]
            rows.append({"shape": json.dumps(shape.plain()), "page": whole, "paths": list(keys), "texts": texts})
        return pa.array(rows, type=_SHAPE)

    return pages.select("host", shape_of(text).alias("_s")).select("host", "_s.*")


_PARTS = pa.schema([("host", pa.string()), ("part", pa.int32()), ("shape", pa.string())])


def _fold(batches):
    """Wrappers of runs of equal (host, part) in sorted rows."""
    key, wrapper = None, None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            node = restored(json.loads(row["shape"]))
            if (row["host"], row["part"]) == key:
                wrapper = folded(merge(wrapper, node))
                continue
            if key is not None:
                done.append({"host": key[0], "part": key[1], "shape": json.dumps(wrapper.plain())})
            key, wrapper = (row["host"], row["part"]), node
        if done:
            yield pa.RecordBatch.from_pylist(done, _PARTS)
    if key is not None:
        yield pa.RecordBatch.from_pylist([{"host": key[0], "part": key[1], "shape": json.dumps(wrapper.plain())}], _PARTS)


def _folded(shapes, tasks):
    schema = "host string, part int, shape string"
    sorted_rows = shapes.repartition(tasks, "host", "part").sortWithinPartitions("host", "part", "shape")
    return sorted_rows.mapInArrow(_fold, schema)


def infer(pages, fixed_pages=3, shapes_per_part=200, url="url", text="html"):
    """One row per host: ``host``, ``wrapper`` (expression), ``lists`` (paths of articles that repeat), ``fixed``.

    All pages of a host take part; null and empty pages have an empty shape, pages with a null or strange url are of
    the empty host, and an empty table gives no wrappers. Equal shapes count once; a host's shapes are
    aligned in parts of about ``shapes_per_part`` and the parts' wrappers then
    with each other, so a host with a third of all pages is spread out. A block
    is fixed if it stands on all distinct pages that have its path, at least ``fixed_pages`` of them; other blocks
    on the path are not. Pages with the same blocks are one page.
    """
    spark = pages.sparkSession
    hosted = pages.select(host_of(F.col(url)).alias("host"), F.coalesce(F.col(text), F.lit("")).alias("_html"))
    shaped = stage(_shapes(hosted, F.col("_html")).distinct(), "shapes")
    distinct = shaped.select("host", "shape").distinct()
    counts = distinct.groupBy("host").agg(F.count("*").alias("shapes")).select(F.col("host").alias("_h"), "shapes")
    parts = F.pmod(F.xxhash64("shape"), F.ceil(F.col("shapes") / shapes_per_part)).cast("int")
    parted = distinct.join(counts, F.col("host") == F.col("_h")).select("host", parts.alias("part"), "shape")
    tasks = share_of(spark, distinct.count(), 2_000)
    whole = _folded(_folded(parted, tasks).withColumn("part", F.lit(0)), tasks)

    pages_of = shaped.select("host", "page", "paths", "texts").distinct()
    each = pages_of.select("host", F.explode(F.arrays_zip("paths", "texts")).alias("_e")).select("host", "_e.*")
    wide = each.groupBy("host", "paths").agg(F.count("*").alias("n")).where(F.col("n") >= fixed_pages)
    same = each.select("host", "paths", F.explode("texts").alias("block")).groupBy("host", "paths", "block")
    same = same.agg(F.count("*").alias("n")).where(F.col("n") >= fixed_pages)
    fixed = same.join(wide, ["host", "paths", "n"]).groupBy("host").agg(F.collect_set("block").alias("fixed"))
    fixed = fixed.select(F.col("host").alias("_f"), "fixed")

    @F.arrow_udf("struct<wrapper:string,lists:array<string>>")
    def finished(shapes: pa.Array) -> pa.Array:
        rows = []
        for plain in shapes.to_pylist():
            node = restored(json.loads(plain))
            rows.append({"wrapper": expression(node), "lists": lists(node)})
        return pa.array(rows, type=pa.struct([("wrapper", pa.string()), ("lists", pa.list_(pa.string()))]))

    joined = whole.join(fixed, F.col("host") == F.col("_f"), "left")
    return joined.select("host", finished("shape").alias("_w"), "fixed").select("host", "_w.wrapper", "_w.lists", "fixed")


def extract(pages, fixed_pages=3, url="url", text="html", into="text"):
    """Adds ``into``: the main text of each page, its blocks joined by two line ends, in page order.

    Null and empty pages have an empty text, as have pages without content;
    pages with a null or strange url share the wrapper of the empty host;
    repeated rows are extracted each; an empty table gives an empty table. A
    column named ``into`` is replaced. The wrappers, one row per host, are
    staged, so Spark knows their size when it joins them to the pages.
    """
    known = stage(infer(pages, fixed_pages, url=url, text=text).select("host", "lists", "fixed"), "wrappers")
    known = known.select(F.col("host").alias("_host"), F.col("lists").alias("_lists"), F.col("fixed").alias("_fixed"))

    @F.arrow_udf("string")
    def read(htmls: pa.Array, repeated: pa.Array, fixed: pa.Array) -> pa.Array:
        out = []
        for page, many, same in zip(htmls.to_pylist(), repeated.to_pylist(), fixed.to_pylist()):
            out.append("\n\n".join(content_of(blocks_of(page)[0], many or (), same or ())))
        return pa.array(out, type=pa.string())

    both = pages.join(known, host_of(F.col(url)) == F.col("_host"), "left")
    return both.withColumn(into, read(F.coalesce(F.col(text), F.lit("")), F.col("_lists"), F.col("_fixed"))).drop("_host", "_lists", "_fixed")
