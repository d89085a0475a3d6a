"""Main text of web pages: a recurrent network labels every block of a page given all its blocks."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import escape, unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import text_pieces, words

# Pages the network is fitted on, at most; only pages up to this length are taken for it.
FIT_PAGES, FIT_CHARS, ROUNDS = 300, 60_000, 24
_FIT_BLOCKS, _HIDDEN, _PATH_SIZE, _WORD_SIZE = 64, 16, 16, 6
_PATH_BUCKETS, _WORD_BUCKETS, _NUMBERS = 1024, 1024, 4

# Elements of the HTML standard by how they shape text.
_SILENT = "script|style|noscript|template|iframe|object|svg|math|canvas|audio|video|textarea|select"
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr".split())
_EMPTY = frozenset("area base br col embed hr img input link meta param source track".split())
_ENDS_PARAGRAPH = frozenset("address article aside blockquote details div dl dd dt fieldset figcaption figure footer form "
                            "h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table td th tr ul".split())

# Names under which page authors put their main text, and what is not part of it. They teach the network through
# pages that are laid out anew; at work it sees hashed names only.
_MAIN_NAMES = ["article", "main", "div.content", "div#content", "div.post", "div.entry-content", "section.story",
               "div.article-body", "div#main", "article.post"]
_OTHER_NAMES = ["nav", "div.menu", "ul.menu", "div#navbar", "header", "div.header", "footer", "div.footer", "aside",
                "div.sidebar", "div#sidebar", "aside.widget", "div.ad", "div.ads", "div.advert", "div.advertisement",
                "div.sponsored", "div.promo", "div.banner", "div.cookie-notice", "div.cookies", "div.notice",
                "div.consent", "form", "form.search", "form.newsletter", "div.subscribe", "div.comments", "section.comments",
                "section#comments", "div.comment", "ol.comment-list", "div.related", "div.breadcrumbs", "div.share",
                "div.social", "div.popup", "div.login", "ul.pagination"]

_TAG = re.compile(r"<(/?)([a-z][^\s/>]*+)", re.I)
_SILENT_TAG = re.compile(rf"<({_SILENT})\b", re.I)
_SILENT_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in _SILENT.split("|")}
_SPECIAL = re.compile("[>\"']")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[^\W_]+")


@dataclass
class Network:
    """Weights of the network by name."""

    weights: dict[str, np.ndarray]


@dataclass(eq=False, slots=True)
class Place:
    """An element of a page: its names, the element around it, and the number of names on the path to it."""

    around: Place | None
    names: tuple[str, ...]
    size: int

    def path(self) -> tuple[str, ...]:
        """All names from the page down to this element."""
        parts, place = [], self
        while place:
            parts.append(place.names)
            place = place.around
        return tuple(name for names in reversed(parts) for name in names)


class _Ends:
    """Where tags end. Signs inside of quotes do not count, unless the quotes are never closed.

    What was found for a sign is kept, so a page with any number of broken tags is read in time in proportion to it.
    """

    def __init__(self, html: str) -> None:
        self.html, self.last, self.known = html, html.rfind(">"), {}

    def quoted(self, at: int) -> int:
        """Position after the sign that closes a tag whose attributes begin here, 0 without one."""
        signs, end = [], 0
        while at <= self.last:
            sign = _SPECIAL.search(self.html, at).start()
            if sign in self.known:
                end = self.known[sign]
                break
            signs.append(sign)
            if self.html[sign] == ">":
                end = sign + 1
                break
            at = self.html.find(self.html[sign], sign + 1) + 1
            if not at:
                break
        self.known.update(dict.fromkeys(signs, end))
        return end

    def plain(self, at: int) -> int:
        """The same for a tag whose quotes are not closed: the next sign."""
        return self.html.find(">", at) + 1 if at <= self.last else 0


def _tags(html: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Tags and other markup in order: begin, end, whether it is an end tag, its name (empty if there is none) and attributes."""
    ends, at = _Ends(html), html.find("<")
    while at >= 0:
        end, closing, name, rest = 0, False, "", ""
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4) + 3
            end = end if end > 2 else len(html)
        elif tag := _SILENT_TAG.match(html, at):
            if inside := ends.quoted(tag.end()):
                close = _SILENT_ENDS[tag[1].lower()].search(html, inside)
                end = close.end() if close else len(html)
        if not end and at <= ends.last:
            if tag := _TAG.match(html, at):
                end = ends.quoted(tag.end()) or ends.plain(tag.end())
                closing, name, rest = bool(tag[1]), tag[2].lower(), html[tag.end():end - 1]
            elif html.startswith(("<!", "<?", "</"), at):
                end = ends.plain(at + 2)
        if end:
            yield at, end, closing, name, rest
        at = html.find("<", end or at + 1)


def blocks(html: str | None) -> list[tuple[Place, str, float]]:
    """Leaf blocks of a page in order: the element it stands in, its text, and the share of its text in links.

    Broken markup is read as browsers do in the common cases: paragraphs and list items end where the next block
    begins, end tags close what they name and what is open inside, others are ignored, an unclosed comment or script
    runs to the end. Character references are decoded once, white space becomes one space. Time and memory grow in
    proportion to the page, however its tags are broken or nested.
    """
    out: list[tuple[Place, str, float]] = []
    root = Place(None, (), 0)
    path: list[tuple[str, Place]] = []
    opened: Counter[str] = Counter()
    pieces: list[str] = []
    in_link, linked, at = False, 0, 0

    def finish() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(pieces)).split())
        if text:
            out.append((path[-1][1] if path else root, text, min(1.0, linked / len(text))))
        pieces.clear()
        linked = 0

    html = html or ""
    for begin, end, closing, name, rest in _tags(html):
        if begin > at:
            pieces.append(html[at:begin])
            if in_link:
                linked += begin - at
        at = end
        if not name:
            continue
        if name in _INLINE:
            if name == "a":
                in_link = not closing
            continue
        if name == "br" or name in _EMPTY:
            pieces.append(" ")
            continue
        finish()
        if closing:
            while opened[name]:
                last, _ = path.pop()
                opened[last] -= 1
                if last == name:
                    break
            continue
        in_link = False
        if path and (path[-1][0] == "p" and name in _ENDS_PARAGRAPH or path[-1][0] == name and name in ("li", "td", "tr", "option")):
            opened[path.pop()[0]] -= 1
        names = [name]
        for match in _NAMES.finditer(rest):
            names += [part.lower() for part in _PART.findall(match[1] or match[2] or match[3] or "")]
        around = path[-1][1] if path else root
        path.append((name, Place(around, tuple(names), around.size + len(names))))
        opened[name] += 1
    if at < len(html):
        pieces.append(html[at:])
    finish()
    return out


def _inputs(pages: list[list[tuple]]) -> dict:
    """What the network reads of all blocks: name buckets with the element they belong to, elements with those around
    them, word buckets with the block they belong to, and numbers."""
    flat = [block for page in pages for block in page]
    names, owners, around, depth, known = [], [], [], [], {}
    for place, _, _ in flat:
        way = []
        while place and place not in known:
            way.append(place)
            place = place.around
        for place in reversed(way):
            known[place] = len(known)
            names += [_bucket(n, _PATH_BUCKETS) for n in place.names]
            owners += [known[place]] * len(place.names)
            around.append(known[place.around] if place.around else 0)
            depth.append(depth[around[-1]] + 1 if place.around else 0)
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.cumsum(np.bincount(depth))[:-1]) if depth else []
    word_buckets, word_owners = [], []
    for first, _, data, offsets in text_pieces(pa.array([b[1] for b in flat], pa.string())):
        hashes, first_word = words(data, offsets)
        word_buckets.append((hashes >> np.uint64(40)).astype(np.int64) % _WORD_BUCKETS)
        word_owners.append(first + np.repeat(np.arange(len(offsets) - 1), np.diff(first_word)))
    size = np.array([len(b[1]) for b in flat], float)
    stops = np.array([b[1][-1] in ".!?" for b in flat], float)
    lengths = np.array([len(p) for p in pages])
    numbers = np.stack([np.log1p(size) / 5, [b[2] for b in flat], stops, [min(b[0].size, 12) / 12 for b in flat]], axis=1)
    join = lambda parts: np.concatenate([*parts, np.empty(0, np.int64)]).astype(np.int64)
    return {"path": np.array(names, np.int64), "path_of": np.array(owners, np.int64), "around": np.array(around, np.int64),
            "levels": levels[1:], "place": np.array([known[b[0]] for b in flat], np.int64),
            "path_counts": np.array([max(b[0].size, 1) for b in flat]), "word": join(word_buckets),
            "word_of": join(word_owners), "numbers": numbers, "lengths": lengths}


@lru_cache(1 << 16)
def _bucket(name: str, buckets: int) -> int:
    value = 1469598103934665603
    for byte in name.encode():
        value = (value ^ byte) * 1099511628211 % (1 << 64)
    return (value >> 20) % buckets


def _sums(table: np.ndarray, buckets: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(owners, table[buckets, k], n) for k in range(table.shape[1])], axis=1)


def _path_means(table: np.ndarray, inputs: dict) -> np.ndarray:
    """Mean over all names on the path to each block: sums go from each element to those inside it."""
    sums = _sums(table, inputs["path"], inputs["path_of"], len(inputs["around"]))
    for level in inputs["levels"]:
        sums[level] += sums[inputs["around"][level]]
    return sums[inputs["place"]] / inputs["path_counts"][:, None]


def _path_slopes(slope: np.ndarray, own: np.ndarray, inputs: dict) -> None:
    """Add the slopes of `_path_means` to those of the table."""
    sums = _sums(own / inputs["path_counts"][:, None], np.arange(len(own)), inputs["place"], len(inputs["around"]))
    for level in reversed(inputs["levels"]):
        np.add.at(sums, inputs["around"][level], sums[level])
    np.add.at(slope, inputs["path"], sums[inputs["path_of"]])


def _padded(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For step and page the block read forwards and backwards, and whether there is one."""
    first = np.cumsum(lengths) - lengths
    step = np.arange(lengths.max(initial=0))[:, None]
    there = step < lengths
    return np.where(there, first + step, 0), np.where(there, first + lengths - 1 - step, 0), there


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _recur(x: np.ndarray, there: np.ndarray, weights: dict, side: str, keep: list | None = None) -> np.ndarray:
    """Long short-term memory over steps; states of pages that have ended stay as they are."""
    pages = x.shape[1]
    h, c, out = np.zeros((pages, _HIDDEN)), np.zeros((pages, _HIDDEN)), np.empty((*x.shape[:2], _HIDDEN))
    into = x @ weights[f"in_{side}"] + weights[f"bias_{side}"]
    for t in range(len(x)):
        gates = into[t] + h @ weights[f"loop_{side}"]
        opened, new = _sigmoid(gates[:, :3 * _HIDDEN]), np.tanh(gates[:, 3 * _HIDDEN:])
        put, forget, show = np.split(opened, 3, axis=1)
        old_h, old_c, on = h, c, there[t][:, None]
        cell = forget * c + put * new
        bent = np.tanh(cell)
        c, h = np.where(on, cell, c), np.where(on, show * bent, h)
        out[t] = h
        if keep is not None:
            keep.append((put, forget, show, new, bent, old_h, old_c))
    return out


def _recur_back(slope: np.ndarray, x: np.ndarray, there: np.ndarray, weights: dict, side: str, kept: list,
                slopes: dict) -> np.ndarray:
    dh, dc, dx = np.zeros(slope.shape[1:]), np.zeros(slope.shape[1:]), np.empty_like(x)
    for t in range(len(x) - 1, -1, -1):
        put, forget, show, new, bent, old_h, old_c = kept[t]
        on = there[t][:, None]
        dh = dh + slope[t]
        cell = dc + dh * show * (1 - bent ** 2)
        gates = np.concatenate([cell * new * put * (1 - put), cell * old_c * forget * (1 - forget),
                                dh * bent * show * (1 - show), cell * put * (1 - new ** 2)], axis=1) * on
        slopes[f"in_{side}"] += x[t].T @ gates
        slopes[f"loop_{side}"] += old_h.T @ gates
        slopes[f"bias_{side}"] += gates.sum(0)
        dx[t] = gates @ weights[f"in_{side}"].T
        dh, dc = np.where(on, gates @ weights[f"loop_{side}"].T, dh), np.where(on, cell * forget, dc)
    return dx


def _scores(inputs: dict, weights: dict, keep: dict | None = None) -> np.ndarray:
    """Logit of each block for being main text."""
    n = len(inputs["numbers"])
    path = _path_means(weights["path"], inputs)
    word_counts = np.maximum(np.bincount(inputs["word_of"], minlength=n), 1)
    word = _sums(weights["word"], inputs["word"], inputs["word_of"], n) / word_counts[:, None]
    x = np.concatenate([path, word, inputs["numbers"]], axis=1)
    ahead, behind, there = _padded(inputs["lengths"])
    out, states = np.zeros((n, 2 * _HIDDEN)), {}
    for side, order, part in (("ahead", ahead, slice(0, _HIDDEN)), ("behind", behind, slice(_HIDDEN, None))):
        kept = [] if keep is not None else None
        out[order[there], part] = _recur(x[order], there, weights, side, kept)[there]
        states[side] = order, kept
    whole = np.concatenate([out, x], axis=1)
    if keep is not None:
        keep.update(x=x, whole=whole, there=there, states=states, word_counts=word_counts)
    return whole @ weights["out"] + weights["bias_out"][0]


def _slopes(inputs: dict, weights: dict, truth: np.ndarray) -> dict:
    kept: dict = {}
    logits = _scores(inputs, weights, kept)
    gap = (_sigmoid(logits) - truth) / len(truth)
    slopes = {k: np.zeros_like(v) for k, v in weights.items()}
    slopes["out"], slopes["bias_out"] = kept["whole"].T @ gap, np.array([gap.sum()])
    back = np.outer(gap, weights["out"])
    dx = back[:, 2 * _HIDDEN:].copy()
    for side, part in (("ahead", slice(0, _HIDDEN)), ("behind", slice(_HIDDEN, 2 * _HIDDEN))):
        order, states = kept["states"][side]
        slope = np.where(kept["there"][:, :, None], back[:, part][order], 0)
        moved = _recur_back(slope, kept["x"][order], kept["there"], weights, side, states, slopes)
        np.add.at(dx, order[kept["there"]], moved[kept["there"]])
    _path_slopes(slopes["path"], dx[:, :_PATH_SIZE], inputs)
    own = dx[:, _PATH_SIZE:_PATH_SIZE + _WORD_SIZE] / kept["word_counts"][:, None]
    np.add.at(slopes["word"], inputs["word"], own[inputs["word_of"]])
    return slopes


def _new_weights(rng: np.random.Generator) -> dict[str, np.ndarray]:
    width = _PATH_SIZE + _WORD_SIZE + _NUMBERS
    weights = {"path": rng.normal(0, 0.5, (_PATH_BUCKETS, _PATH_SIZE)), "word": rng.normal(0, 0.1, (_WORD_BUCKETS, _WORD_SIZE)),
               "out": rng.normal(0, 0.1, 2 * _HIDDEN + width), "bias_out": np.zeros(1)}
    for side in ("ahead", "behind"):
        weights[f"in_{side}"] = rng.normal(0, width ** -0.5, (width, 4 * _HIDDEN))
        weights[f"loop_{side}"] = rng.normal(0, _HIDDEN ** -0.5, (_HIDDEN, 4 * _HIDDEN))
        weights[f"bias_{side}"] = np.repeat([0.0, 1.0, 0.0, 0.0], _HIDDEN)
    return weights


def _told_by_names(path: tuple[str, ...]) -> bool:
    """Whether a block is main text by the names on its path; the teacher of the network."""
    names = set(path)
    other = {part for name in _OTHER_NAMES for part in re.split(r"[.#-]", name)} - {"div", "section", "ul", "ol"}
    return bool(names & {"article", "main"}) and not names & (other | {"head", "title"})


def _laid_out_anew(pages: list[list[tuple]], rng: np.random.Generator) -> Iterator[str]:
    """Pages with the main text and the other texts of the given ones, in other layouts."""
    main = [[b[1] for b in page if _told_by_names(b[0].path())] for page in pages]
    rest = [b[1] for page in pages for b in page if not _told_by_names(b[0].path())] or ["more"]
    pick = lambda items: items[int(rng.integers(len(items)))]

    def wrap(name: str, inner: str) -> str:
        tag, kind, value = re.fullmatch(r"(\w+)(?:([.#])(.*))?", name).groups()
        attribute = "" if not kind else f' class="{value}"' if kind == "." else f' id="{value}"'
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def other() -> str:
        whole = pick(main) or rest
        texts = [pick(whole) if rng.random() < 0.5 else pick(rest) for _ in range(int(rng.integers(1, 5)))]
        form = pick(["p", "li", "div", "a", "span"])
        return wrap(pick(_OTHER_NAMES), "".join(wrap(form, escape(t)) + ("<br>" if form in ("a", "span") else "") for t in texts))

    for texts in main:
        if not texts:
            continue
        texts = [pick(rest) if rng.random() < 0.2 else pick(texts) if rng.random() < 0.1 else t for t in texts]
        texts += [texts[-1]] * int(rng.integers(0, 12)) if rng.random() < 0.3 else []
        texts = [" ".join(t.split()[:int(rng.integers(1, 4))]) if rng.random() < 0.15 else t for t in texts]
        inner = "".join(wrap("h1" if not i else pick(["p", "p", "p", "div", "h2", "li"]), escape(t)) for i, t in enumerate(texts))
        if rng.random() < 0.4:
            half = len(inner) // 2
            cut = inner.find("<p>", half)
            inner = inner[:cut] + other() + inner[cut:] if cut > 0 else inner + other()
        before = "".join(other() for _ in range(int(rng.integers(0, 4))))
        after = "".join(other() for _ in range(int(rng.integers(0, 4))))
        body = before + wrap(pick(_MAIN_NAMES), inner) + after
        body = wrap(pick(["div", "div.page", "div#wrapper"]), body) if rng.random() < 0.5 else body
        yield f"<html><head><title>{escape(texts[0])}</title></head><body>{body}</body></html>"


def _told_main(path: tuple[str, ...]) -> bool:
    """As `_told_by_names`, for laid out pages, where other names than `article` hold the main text."""
    holders = {part for name in _MAIN_NAMES for part in re.split(r"[.#-]", name)} - {"div", "section"}
    return bool(set(path) & holders) and _told_by_names((*path, "article"))


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", fit_pages: int = FIT_PAGES,
        rounds: int = ROUNDS, seed: int = 7) -> Network:
    """Fit on at most `fit_pages` pages of up to `FIT_CHARS` characters, the first in the order of their id's hash.

    There are no labels, so blocks are labelled by the names that authors give to parts of a page. Each page is also
    laid out anew in three ways, with main text, menus, notices, adverts, forms and comments under other names, so that
    the network learns from paths, words and neighbours what holds beyond the layouts at hand. Without pages it is
    fitted on a made-up one.
    """
    place = F.xxhash64(F.col(id_col).cast("string"))
    thin = pages.where(F.length(html_col) <= FIT_CHARS).select(F.col(id_col).alias("key"), place.alias("place"))
    chosen = thin.where("key IS NOT NULL").orderBy("place", "key").limit(fit_pages).select("key").distinct()
    sample = pages.select(F.col(id_col).alias("key"), F.col(html_col).alias("html")).where(F.length("html") <= FIT_CHARS).join(
        F.broadcast(chosen), "key")
    # Cut by executors, one partition at the end: a limit that is collected itself would send each partition's rows here.
    sample = sample.orderBy("key", "html").limit(fit_pages).coalesce(1).toPandas().sort_values(["key", "html"])["html"].tolist()
    return learn(sample, rounds, seed)


def learn(sample: list[str], rounds: int = ROUNDS, seed: int = 7) -> Network:
    """Fit on the given pages, as they are and laid out anew."""
    made_up = "<html><body><nav><li>Menu</li></nav><article><h1>Title</h1><p>Some words.</p></article><footer>End</footer></body></html>"
    read = [blocks(html) for html in sample or [made_up] * 8]
    rng = np.random.default_rng(seed)
    examples = [(page, [_told_by_names(b[0].path()) for b in page]) for page in read]
    for _ in range(3):
        for html in _laid_out_anew(read, rng):
            page = blocks(html)
            examples.append((page, [_told_main(b[0].path()) for b in page]))
    cut = []
    for page, truth in examples:
        begin = int(rng.integers(0, max(1, len(page) - _FIT_BLOCKS + 1))) if rng.random() < 0.5 else 0
        cut.append((page[begin:begin + _FIT_BLOCKS], truth[begin:begin + _FIT_BLOCKS]))
    cut = [x for x in cut if x[0]]
    order = rng.permutation(len(cut))
    groups = [[cut[i] for i in part] for part in np.array_split(order, max(1, len(cut) // 64))]
    ready = [(_inputs([p for p, _ in g]), np.concatenate([t for _, t in g]).astype(float)) for g in groups if g]

    weights = _new_weights(rng)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in weights.items()}
    calm = {k: v.copy() for k, v in weights.items()}
    t = 0
    for turn in range(rounds):
        rate = 0.02 * (1 - turn / rounds) + 0.001
        for inputs, truth in ready:
            t += 1
            for name, slope in _slopes(inputs, weights, truth).items():
                first, second = moments[name]
                first += 0.1 * (slope - first)
                second += 0.01 * (slope ** 2 - second)
                weights[name] -= rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
                calm[name] += 0.02 * (weights[name] - calm[name])
    return Network(calm)  # the running mean of the weights strays less than the last ones


def main_blocks(pages: list[list[tuple]], network: Network) -> list[np.ndarray]:
    """For each page which of its blocks are main text."""
    flags: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
    group: list[int] = []
    for at, i in enumerate(order):
        group.append(i)
        longest = len(pages[i])
        if at + 1 == len(order) or (len(group) + 1) * len(pages[order[at + 1]]) > 40_000:
            if longest:
                inputs = _inputs([pages[k] for k in group])
                main = _scores(inputs, network.weights) > 0
                for k, part in zip(group, np.split(main, np.cumsum(inputs["lengths"])[:-1])):
                    flags[k] = part
            group = []
    return flags


def main_text(pages: DataFrame, network: Network, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """`page_id`, `url`, `text` and `n_chars` of every row: its main blocks in order, joined by a space.

    Null and empty pages, and pages without main text, give an empty text. Each row is read on its own, so ids may be
    null or repeated; other columns are ignored. Pages are read whole, however long.
    """

    def extracted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                read = [blocks(html) for html in part.column(2).to_pylist()]
                texts = [" ".join(b[1] for b, keep in zip(page, flags) if keep)
                         for page, flags in zip(read, main_blocks(read, network))]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                ], names=["page_id", "url", "text", "n_chars"])

    return pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    ).mapInArrow(extracted, "page_id bigint, url string, text string, n_chars bigint")
