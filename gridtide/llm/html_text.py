"""Main text of web pages: markup first, then what a host's pages share.

A page is cut into blocks by its block elements. Blocks inside navigation,
footers, forms, scripts and the like are out. Of the others those inside an
article are asked for, or all on a page without one, and the host decides: the
token streams of all of its pages are laid end to end, their suffixes are sorted
by their first ``run`` tokens, and a run that starts in enough distinct pages is
boilerplate. A block of which such runs cover the most goes; unique runs stay, a
page of nothing else keeps what it has, and so does an article of which they
cover the most, as it is republished.

Pages of the same token stream are one page. A host is dealt out to groups of
about ``group_pages`` pages by a hash of the stream, so that no group grows with
a host. Each group counts the pages of its runs, the counts of a run are added
up over the host, and the groups that hold it are told: the verdict is the same
however many groups there are. Only the pages that lose blocks are told back.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import keep_table
from gridtide.llm.components import BROADCAST_ROWS

# Elements, and words in class, id and role, that hold no main text.
OUT = frozenset(
    "script style noscript template head title nav header footer aside form button select textarea option label "
    "iframe object svg canvas dialog menu".split()
)
OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer footer header masthead menu menubar modal nav navbar navigation newsletter notice notices popup promo promoted "
    "promotion related respond replies share sharing sidebar skip social sponsor sponsored subscribe subscription toolbar widget "
    "contentinfo complementary search".split()
)
COMMENT = frozenset(("comment", "comments"))
NO_TEXT = COMMENT | {"notice", "notices"}
MARKED, FOR_GOOD = 1, 2
# By how many bits of a hash the groups of a host know a run.
RUN_BITS = 48
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
NAMED = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PARTS = re.compile(r"[A-Za-z]+")


def _words(attributes: str) -> set[str]:
    return {w.lower() for _, *v in NAMED.findall(attributes) for w in PARTS.findall("".join(v))}


def _out(name: str, attributes: str) -> int:
    """How far an element is out: not, by a mark in its class, id or role, or
    for good."""
    if name in OUT:
        return FOR_GOOD
    if name in ("body", "html", "main"):
        return 0
    if name == "article":
        return FOR_GOOD if _words(attributes) & COMMENT else 0
    return MARKED if _words(attributes) & OUT_WORDS else 0


def page_blocks(page: str) -> list[tuple[str, str]]:
    """(state, text) of each block in page order; the state is 'out', 'main'
    or 'open'. Unclosed elements end with what they stand in.

    A mark may be on a widget or on a wrapper of the whole page, so an article
    or main element inside one is looked at in its own right: of the articles
    under no mark, one, two and so on those that hold the most words are main
    text, with those under fewer marks. Inside an article marks hold."""
    blocks: list[tuple[str, int, str]] = []
    held: list[str] = []
    stack: list[tuple[str, int, int, bool, bool]] = []  # name, out, marks around, main, in an article

    def state() -> tuple[int, int, bool, bool]:
        return stack[-1][1:] if stack else (0, 0, False, False)

    def close() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out, marks, main, _ = state()
            blocks.append(("out" if out else "main" if main else "open", marks, text))

    at = 0
    while at < len(page):
        found = MARKUP.search(page, at)
        if not found:
            held.append(page[at:])
            break
        held.append(page[at : found.start()])
        at = found.end()
        slash, name, attributes = found[1], (found[2] or "").lower(), found[3] or ""
        if not name:
            continue
        if slash:
            if name in BLOCK or any(s[0] == name and s[1] for s in stack):
                close()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
            continue
        is_out = _out(name, attributes)
        if name in BLOCK or is_out:
            close()
        if name in VOID or attributes.rstrip().endswith("/"):
            continue
        if name in RAW:  # its content is text up to its own end
            at = re.compile(rf"</{name}\s*>|\Z", re.I).search(page, at).end()
            continue
        if name == "p" and stack and stack[-1][0] == "p":
            stack.pop()
        out, marks, main, in_article = state()
        if out == MARKED and not is_out and (name == "main" or (name == "article" and not in_article)) and not _words(attributes) & NO_TEXT:
            out = 0
        stack.append(
            (name, max(out, is_out), marks + (is_out == MARKED), main or name in ("article", "main"), in_article or name == "article")
        )
    close()
    words = Counter()
    for kind, marks, text in blocks:
        if kind == "main":
            words[marks] += text.count(" ") + 1
    most = max(words, key=lambda marks: (words[marks], -marks), default=0)
    return [("out" if kind == "main" and marks > most else kind, text) for kind, marks, text in blocks]


def runs_of(tokens: np.ndarray, page: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where runs of ``run`` tokens of one page start, which run it is, and in
    how many distinct pages each run starts. Suffixes are sorted by prefix
    doubling up to that depth, which settles every repeat of at least that
    length."""
    n = len(tokens)
    rank, depth = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    at = np.arange(n)
    fits = np.zeros(n, dtype=bool)
    if n >= run:
        fits[: n - run + 1] = page[: n - run + 1] == page[run - 1 :]
    while depth < run:
        step = min(depth, run - depth)
        later = np.where(at + step < n, rank[np.minimum(at + step, n - 1)] + 1, 0)
        rank = np.unique(rank * (int(later.max(initial=0)) + 1) + later, return_inverse=True)[1].astype(np.int64)
        depth += step
    starts = np.flatnonzero(fits)
    order = starts[np.lexsort((page[starts], rank[starts]))]
    new_group = np.diff(rank[order], prepend=-1) != 0
    new_page = new_group | (np.diff(page[order], prepend=-1) != 0)
    group = np.cumsum(new_group) - 1
    return order, group, np.bincount(group, weights=new_page).astype(np.int64) if len(order) else np.zeros(0, np.int64)


def covered_by(starts: np.ndarray, n: int, run: int) -> np.ndarray:
    """Which of ``n`` tokens the runs that start there cover."""
    covered = np.zeros(n + 1, dtype=np.int64)
    covered[starts] += 1
    np.add.at(covered, starts + run, -1)
    return np.cumsum(covered)[:-1] > 0


def repeated_tokens(tokens: np.ndarray, page: np.ndarray, run: int, min_pages: int, share: float = 0.0) -> np.ndarray:
    """Which tokens are covered by runs of ``run`` tokens that start in enough
    distinct pages."""
    order, group, pages = runs_of(tokens, page, run)
    needed = max(min_pages, int(np.ceil(share * len(np.unique(page)))))
    return covered_by(order[pages[group] >= needed], len(tokens), run)


def run_hashes(words: list[str], tokens: np.ndarray, starts: np.ndarray, run: int) -> np.ndarray:
    """The same 64 bits for the same run in every group."""
    of_word = np.array([int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") for w in words], np.uint64)
    sums = np.zeros(len(starts), np.uint64)
    for step in range(run):
        sums = sums * np.uint64(0x9E3779B97F4A7C15) + of_word[tokens[starts + step]]
    return sums.view(np.int64)


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _content(page: str) -> bytes:
    """A line with the letter of each block's state, then a line for each block."""
    blocks = page_blocks(page)
    return "\n".join(["".join(state[1] for state, _ in blocks), *(text for _, text in blocks)]).encode("utf-8", "surrogatepass")


def _blocks(content: bytes) -> tuple[str, list[str]]:
    """The states, 'u' for out, 'a' for main and 'p' for open, and the texts."""
    states, *blocks = content.decode("utf-8", "surrogatepass").split("\n")
    return states, blocks


def _asked(states: str) -> str:
    """The state of the blocks that are text unless the host's runs say otherwise."""
    return "a" if "a" in states else "p"


def _packed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(raw, asbytes=True)


def _unpacked(block: bytes) -> bytes:
    return pa.Codec("zstd").decompress(block[8:], int.from_bytes(block[:8], "little"), asbytes=True)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with blocks, each content of a host once in a task."""
    seen = set()
    for batch in batches:
        found = []
        for host, groups, page in zip(*(batch.column(c).to_pylist() for c in ("host", "groups", "html")), strict=True):
            content = _content(page)
            digest = hashlib.blake2b(content, digest_size=16).digest()
            if content and (host, digest) not in seen:
                seen.add((host, digest))
                stream = _digest(" ".join(_blocks(content)[1]))
                found.append((host, groups, stream, digest, _packed(content)))
        columns = list(zip(*found, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
            names=["host", "groups", "stream", "page", "content"],
        )


class _Group:
    """The token streams of a group of pages, each of them once."""

    def __init__(self, table: pa.Table):
        numbers: dict[str, int] = {}
        tokens, owner = [], []
        self.at: dict[bytes, int] = {}
        self.blocks: dict[bytes, tuple[str, list[str], bytes]] = {}
        for stream, page, content in zip(*(table.column(c).to_pylist() for c in ("stream", "page", "content")), strict=True):
            if page in self.blocks:
                continue
            states, texts = _blocks(_unpacked(content))
            self.blocks[page] = (states, texts, stream)
            if stream not in self.at:
                self.at[stream] = len(tokens)
                words = [w for text in texts for w in text.split(" ")]
                tokens += [numbers.setdefault(w, len(numbers)) for w in words]
                owner += [len(self.at)] * len(words)
        self.words, self.tokens, self.owner = list(numbers), np.array(tokens, np.int64), np.array(owner, np.int64)


def _short(hashes: np.ndarray) -> np.ndarray:
    """The leading RUN_BITS bits."""
    return hashes.view(np.uint64) >> np.uint64(64 - RUN_BITS)


def pack_runs(runs: np.ndarray, pages: np.ndarray) -> bytes:
    """Runs, sorted, as differences; bytes of one weight stand together."""
    steps = np.diff(runs, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return _packed(np.ascontiguousarray(steps.T).tobytes() + pages.astype("<i4").tobytes())


def unpack_runs(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = _unpacked(block)
    n = len(raw) // 12
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n).reshape(8, n).T).view("<u8")[:, 0]
    return np.cumsum(steps, dtype=np.uint64), np.frombuffer(raw, "<i4", n, 8 * n).astype(np.int64)


RUNS = "host string, bucket bigint, part bigint, block binary"


def _counted_runs(run: int):
    def counted(table: pa.Table) -> pa.Table:
        """In how many pages of a group each run starts, if its host has several
        groups; a bucket for each range of the hashes."""
        out = []
        groups = table.column("groups")[0].as_py()
        if groups > 1:
            part = _Group(table)
            order, group, pages = runs_of(part.tokens, part.owner, run)
            first = order[np.flatnonzero(np.diff(group, prepend=-1))]
            runs = _short(run_hashes(part.words, part.tokens, first, run))
            by_run = np.argsort(runs)
            runs, pages = runs[by_run], pages[by_run]
            bucket = ((runs >> np.uint64(RUN_BITS - 32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            out = [(int(bucket[s]), pack_runs(runs[s:e], pages[s:e])) for s, e in zip(cuts, [*cuts[1:], len(runs)], strict=True)]
        return pa.table(
            {
                "host": pa.array([table.column("host")[0].as_py()] * len(out), pa.string()),
                "bucket": pa.array([b for b, _ in out], pa.int64()),
                "part": pa.array([table.column("part")[0].as_py()] * len(out), pa.int64()),
                "block": pa.array([x for _, x in out], pa.binary()),
            }
        )

    return counted


def _often(min_pages: int):
    def often(table: pa.Table) -> pa.Table:
        """For each group, which of its runs start in enough pages of the host."""
        parts = table.column("part").to_pylist()
        each = [unpack_runs(b) for b in table.column("block").to_pylist()]
        runs, at = np.unique(np.concatenate([r for r, _ in each]), return_inverse=True)
        pages = np.bincount(at, weights=np.concatenate([p for _, p in each]), minlength=len(runs))
        out, end = [], 0
        for part, (own, _) in zip(parts, each, strict=True):
            enough = own[pages[at[end : end + len(own)]] >= min_pages]
            end += len(own)
            if len(enough):
                out.append((part, pack_runs(np.unique(enough), np.zeros(len(np.unique(enough))))))
        return pa.table(
            {
                "host": pa.array([table.column("host")[0].as_py()] * len(out), pa.string()),
                "bucket": pa.array([table.column("bucket")[0].as_py()] * len(out), pa.int64()),
                "part": pa.array([p for p, _ in out], pa.int64()),
                "block": pa.array([x for _, x in out], pa.binary()),
            }
        )

    return often


def dropped_blocks(states: str, sizes: list[int], covered: list[int]) -> bytes:
    """A byte for each block, 1 if it goes, or nothing if none does. Of the
    blocks asked for those go of which shared runs cover more than half. All of
    an article stay if such runs cover more than half of it, as it is a
    republished one then, and a page never loses all it has."""
    asked = [state == _asked(states) for state in states]
    goes = [a and 2 * c > n for a, n, c in zip(asked, sizes, covered, strict=True)]
    if _asked(states) == "a" and 2 * sum(c for a, c in zip(asked, covered, strict=True) if a) > sum(n for a, n in zip(asked, sizes, strict=True) if a):
        return b""
    return bytes(goes) if any(goes) and goes != asked else b""


def _judged_pages(run: int, min_pages: int):
    def judged(table: pa.Table, often: pa.Table) -> pa.Table:
        """The pages that lose blocks."""
        out = []
        if table.num_rows:
            part = _Group(table)
            if table.column("groups")[0].as_py() == 1:
                shared = repeated_tokens(part.tokens, part.owner, run, min_pages)
            else:
                n = len(part.tokens)
                starts = np.flatnonzero(part.owner[: n - run + 1] == part.owner[run - 1 :]) if n >= run else np.zeros(0, np.int64)
                enough = np.concatenate([np.zeros(0, np.uint64), *(unpack_runs(b)[0] for b in often.column("block").to_pylist())])
                shared = covered_by(starts[np.isin(_short(run_hashes(part.words, part.tokens, starts, run)), enough)], n, run)
            covered = np.concatenate([[0], np.cumsum(shared)])
            for page, (states, texts, stream) in part.blocks.items():
                sizes = [text.count(" ") + 1 for text in texts]
                ends = part.at[stream] + np.cumsum([0, *sizes])
                goes = dropped_blocks(states, sizes, np.diff(covered[ends]).tolist())
                if goes:
                    out.append((page, goes))
        return pa.table(
            {
                "of_host": pa.array([table.column("host")[0].as_py()] * len(out), pa.string()),
                "of_page": pa.array([p for p, _ in out], pa.binary()),
                "dropped": pa.array([d for _, d in out], pa.binary()),
            }
        )

    return judged


def _page_contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        contents = [_content(page) for page in batch.column("html").to_pylist()]
        digests = [hashlib.blake2b(c, digest_size=16).digest() for c in contents]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("page_id", "url", "host")), pa.array(digests, pa.binary()), pa.array(contents, pa.binary())],
            names=["page_id", "url", "host", "page", "content"],
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for content, dropped in zip(batch.column("content").to_pylist(), batch.column("dropped").to_pylist(), strict=True):
            states, texts = _blocks(content)
            goes = dropped or bytes(len(states))
            out.append(" ".join(text for state, text, gone in zip(states, texts, goes, strict=True) if state == _asked(states) and not gone))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def extract_text(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    markup: str = "html",
    run: int = 8,
    min_pages: int = 3,
    group_pages: int = 1000,
) -> DataFrame:
    """Per page: ``key``, ``url``, ``text``, its blocks of main text joined by
    one space.

    A block goes if more than half of its tokens are in runs that at least
    ``min_pages`` pages of its host have. An article of which more than half of
    all tokens are in such runs is a republished one and keeps all its blocks.
    Pages of the same token stream count as one, and a page of nothing but such
    blocks keeps them all. Runs of hosts of several groups are known by
    ``RUN_BITS`` bits of a hash.
    Null and empty pages give an empty text, and so do pages whose markup puts
    every block out. Pages without a host (null url) form a host of their own.
    Repeated rows come out as often as they go in. Other columns are ignored.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    rows = pages.select(
        F.col(key).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(markup).cast("string"), F.lit("")).alias("html"), host.alias("host")
    )
    key_type, url_type = (rows.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    sizes = rows.groupBy("host").agg(F.count("*").alias("n")).select(F.col("host").alias("of_host"), F.ceil(F.col("n") / group_pages).alias("groups"))
    if sizes.limit(100_001).count() <= 100_000:
        sizes = F.broadcast(sizes)
    asked = rows.join(sizes, rows["host"] == sizes["of_host"]).select("host", "groups", "html")
    # Pages that differ only in blocks share a group.
    dealt = asked.mapInArrow(_streams, "host string, groups bigint, stream binary, page binary, content binary").withColumn(
        "part", F.pmod(F.xxhash64("stream"), "groups")
    )
    counted = dealt.groupBy("host", "part").applyInArrow(_counted_runs(run), RUNS)
    often = counted.groupBy("host", "bucket").applyInArrow(_often(min_pages), RUNS)
    judged = dealt.groupBy("host", "part").cogroup(often.groupBy("host", "part")).applyInArrow(
        _judged_pages(run, min_pages), "of_host string, of_page binary, dropped binary"
    )
    judged = keep_table(judged, "dropped-blocks")
    judged = F.broadcast(judged) if judged.count() <= BROADCAST_ROWS else judged.hint("merge")
    parsed = rows.mapInArrow(_page_contents, f"page_id {key_type}, url {url_type}, host string, page binary, content binary")
    found = parsed.join(judged, (parsed["host"] == judged["of_host"]) & (parsed["page"] == judged["of_page"]), "left")
    texts = found.select("page_id", "url", "content", "dropped").mapInArrow(_texts, f"page_id {key_type}, url {url_type}, text string")
    return texts.select(F.col("page_id").alias(key), F.col("url").alias(url), "text")
