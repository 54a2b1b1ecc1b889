"""Parsers of untrusted payloads into rows: playlists, JSON, XML, HLS, and what a body looks like."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

_ATTRIBUTE = re.compile(r'([A-Za-z0-9-]+)="([^"]*)"')
M3U = "source_id string, ordinal int, name string, url string, tvg_id string, group string, logo string, epg string, headers map<string,string>, issue string"


def play_lines(text: Column) -> Column:
    """Lines at ``$$$``, episodes at ``#``, title and URL at the first ``$``; trailing empty episodes drop."""
    lines = F.split(F.regexp_replace(text, r"\$\$\$", "\u0001"), "\u0001")
    cut = lambda e: F.struct(F.substring_index(e, "$", 1).alias("title"), F.regexp_replace(e, r"(?s)^[^$]*\$", "").alias("url"))
    return F.transform(lines, lambda line: F.transform(F.split(F.regexp_replace(line, "#+$", ""), "#"), cut))


def play_line_issue(names: Column, text: Column) -> Column:
    """What is wrong with play lines: counts that differ, empty episodes, or URLs that aren't HTTP(S)."""
    lines = play_lines(text)
    episodes = F.flatten(lines)
    marks = F.size(F.split(F.regexp_replace(names, r"\$\$\$", "\u0001"), "\u0001"))
    return (
        F.when(marks != F.size(lines), "line_count")
        .when(F.exists(episodes, lambda e: e["url"] == ""), "empty_episode")
        .when(F.exists(episodes, lambda e: ~e["url"].rlike(r"^https?://")), "bad_url")
    )


def pointer(text: Column, path: str) -> Column:
    """The value at a JSON pointer; null where it is missing, or the text isn't JSON or repeats a key."""
    parts = [p.replace("~1", "/").replace("~0", "~") for p in path.split("/")[1:]]
    steps = "".join(f"[{p}]" if p.isdigit() else f".{p}" for p in parts)
    return F.try_variant_get(F.try_parse_json(text), "$" + steps, "string")


def html_error(text: Column, markers: list[str]) -> Column:
    """An HTML page with an error marker in its first 16,384 characters."""
    head = F.lower(F.substring(text, 1, 16384))
    return head.rlike("<html|<!doctype html") & head.rlike("|".join(markers))


def txt_live(documents: DataFrame) -> DataFrame:
    """``name,url`` lines of each document under the group line before them."""
    lines = documents.select("source_id", F.posexplode(F.split("content", r"\r?\n")).alias("ordinal", "line")).where("trim(line) <> ''")
    name, rest = F.trim(F.substring_index("line", ",", 1)), F.trim(F.regexp_replace("line", r"^[^,]*,?", ""))
    group = F.last(F.when(rest == "#genre#", name), ignorenulls=True).over(Window.partitionBy("source_id").orderBy("ordinal"))
    issue = F.when(~F.col("line").contains(","), "syntax").when(name == "", "empty_name").when(~rest.rlike(r"^https?://"), "bad_url")
    out = lines.select("source_id", "ordinal", name.alias("name"), rest.alias("url"), group.alias("group"), issue.alias("issue"))
    return out.where("url <> '#genre#'")


def _playlist(text: str) -> Iterator[tuple]:
    """Entries of one playlist in order; header lines hold for the next entry alone."""
    info, headers, ordinal = None, {}, 0
    for raw in text.lstrip("\ufeff").splitlines():
        line = raw.strip()
        if line.startswith("#EXTINF:"):
            found = dict(_ATTRIBUTE.findall(line))
            tail = re.sub(r'"[^"]*"', lambda m: m[0].replace(",", "\0"), line)
            info = (tail.split(",", 1)[1].replace("\0", ",").strip() if "," in tail else "", found)
        elif line.startswith("#EXTVLCOPT:http-"):
            key, _, value = line[len("#EXTVLCOPT:http-") :].partition("=")
            headers[key.strip().lower()] = value.strip()
        elif line.startswith("#EXTHTTP:"):
            try:
                headers |= {str(k).lower(): str(v) for k, v in json.loads(line[9:]).items()}
            except (ValueError, AttributeError):
                headers["?"] = "invalid"
        elif line and not line.startswith("#"):
            url, _, declared = line.partition("|")
            headers |= {k.lower(): v for k, _, v in (p.partition("=") for p in declared.split("&") if p)}
            name, found = info or ("", {})
            issue = "missing_info" if info is None else "empty_name" if not name else "bad_url" if not re.match(r"https?://", url) else "bad_header" if "?" in headers else None
            yield ordinal, name, url, found.get("tvg-id"), found.get("group-title"), found.get("tvg-logo"), found.get("tvg-url"), dict(headers), issue
            info, headers, ordinal = None, {}, ordinal + 1


def m3u_entries(documents: DataFrame) -> DataFrame:
    """Entries of playlists, each with what is wrong with it; a document that isn't UTF-8 gives one row with an issue."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in M3U.split(", ")]
        for pdf in batches:
            rows = []
            for source, content in zip(pdf["source_id"], pdf["content"], strict=True):
                try:
                    text = bytes(content).decode() if content is not None else ""
                except UnicodeDecodeError:
                    rows.append((source, 0, *[None] * 7, "invalid_utf8"))
                    continue
                rows += [(source, *entry) for entry in _playlist(text)]
            yield pd.DataFrame(rows, columns=names)

    return documents.select("source_id", "content").mapInPandas(run, M3U)


_XML = "class struct<ty:array<struct<_id:string,_VALUE:string>>>, list struct<video:array<struct<id:string,name:string,dl:struct<dd:array<struct<_flag:string,_VALUE:string>>>>>>"


def maccms_xml(text: Column) -> Column:
    """A catalogue response in XML; null for documents with a type or entity declaration, or of another shape."""
    safe = F.when(~text.rlike("(?i)<!(doctype|entity)"), text)
    return F.from_xml(safe, _XML, {"rowTag": "rss", "mode": "PERMISSIVE"})


#: Packet sizes of transport streams, with where the first sync byte lies; box types that a media file may begin with; fixed
#: values.
PACKETS = {"ts": (188, 0), "m2ts": (192, 4), "ts_fec": (204, 0)}
BOXES = (b"ftyp", b"styp", b"moof", b"mdat", b"sidx", b"free", b"skip", b"emsg", b"prft")


def _field(data: bytes, bits: int, low: int, size: int) -> int:
    """``size`` bits from bit ``low`` up of the big-endian number that the first ``bits`` bits of the data are."""
    return int.from_bytes(data[: bits // 8]) >> low & (1 << size) - 1


def _packets(b: bytes, size: int, first: int) -> bool:
    """Up to three whole packets with a sync byte, no transport error and a payload or an adaptation field."""
    heads = [b[at : at + 4] for at in range(first, len(b) - size + 1, size)][:3]
    return bool(heads) and all(_field(h, 32, 24, 8) == 0x47 and not _field(h, 32, 23, 1) and _field(h, 32, 4, 2) for h in heads)


def sniffed(body: bytes | None, tagged: bool = True) -> str | None:
    """What kind of media a body begins as; null for none.  A leading tag is skipped, once."""
    b = bytes(body or b"")
    for kind, (size, first) in PACKETS.items():
        if _packets(b, size, first):
            return kind
    if len(b) >= 8 and b[4:8] in BOXES:
        size = _field(b, 32, 0, 32)
        if size == 0 or size >= 8 or (size == 1 and len(b) >= 16 and _field(b[8:], 64, 0, 64) >= 16):
            return "bmff"
    if len(b) >= 4 and _field(b, 16, 5, 11) == 0x7FF:
        if len(b) >= 7 and _field(b, 16, 1, 2) == 0 and _field(b, 16, 4, 1) and _field(b, 24, 2, 4) != 15 and _field(b, 56, 13, 13) >= 7:
            return "adts"
        if _field(b, 16, 1, 2) and _field(b, 24, 4, 4) not in (0, 15) and _field(b, 24, 2, 2) != 3:
            return "mpeg_audio"
    if len(b) >= 8 and b.startswith(b"\x1aE\xdf\xa3") and re.search(b"(?i)webm|matroska", b[:4096]):
        return "ebml"
    if len(b) >= 9 and b.startswith(b"FLV\x01") and b[4] in (1, 4, 5) and _field(b[5:], 32, 0, 32) >= 9:
        return "flv"
    if len(b) >= 7 and b.startswith(b"\x0bw"):
        return "ac3"
    if tagged and len(b) >= 10 and b.startswith(b"ID3") and not any(x & 0x80 for x in b[6:10]):
        skip = 10
        for i, x in enumerate(b[6:10]):
            skip += x << 7 * (3 - i)
        return sniffed(b[skip:], False)
    return None


@F.pandas_udf(T.StringType())
def media_kind(bodies: pd.Series) -> pd.Series:
    """What kind of media a body begins as; null for none."""
    return bodies.map(sniffed)


_TOKEN = re.compile(r"""\s+|//[^\n]*|/\*.*?\*/|(?P<s>"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')|(?P<p>[{}\[\]:,])|(?P<w>[^\s{}\[\]:,"'/]+)""", re.S)


def _relaxed(text: str) -> object:
    """The value of a relaxed JSON text: comments, single quotes, bare keys, trailing commas, signs and bare fractions."""
    tokens, at = [], 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"character {at}")
        if m.lastgroup:
            tokens.append((m.lastgroup, m[0]))
        at = m.end()
    tokens.reverse()

    def string(raw: str) -> str:
        body = raw[1:-1]
        return json.loads('"' + re.sub(r"\\\n", "", body.replace("\\'", "'") if raw[0] == "'" else body).replace("\n", "\\n") + '"') if raw[0] == '"' or '"' not in body else body

    def value() -> object:
        kind, raw = tokens.pop()
        if raw == "{" and kind == "p":
            out: dict = {}
            while tokens[-1][1] != "}":
                kind, key = tokens.pop()
                key = string(key) if kind == "s" else key
                if tokens.pop()[1] != ":" or key in out:
                    raise ValueError(f"key {key}")
                out[key] = value()
                if tokens[-1][1] == ",":
                    tokens.pop()
            tokens.pop()
            return out
        if raw == "[" and kind == "p":
            items = []
            while tokens[-1][1] != "]":
                items.append(value())
                if tokens[-1][1] == ",":
                    tokens.pop()
            tokens.pop()
            return items
        if kind == "s":
            return string(raw)
        words = {"true": True, "false": False, "null": None}
        if raw in words:
            return words[raw]
        if re.fullmatch(r"[+-]?0[xX][0-9a-fA-F]+", raw):
            return int(raw, 16)
        return int(raw) if re.fullmatch(r"[+-]?\d+", raw) else float(raw)

    out = value()
    if tokens:
        raise ValueError("more after the value")
    return out


@F.pandas_udf(T.StringType())
def json5(texts: pd.Series) -> pd.Series:
    """Relaxed JSON as plain JSON; null where it can't be read or repeats a key."""

    def one(text: str) -> str | None:
        try:
            return json.dumps(_relaxed(text.lstrip("\ufeff")), ensure_ascii=False)
        except (ValueError, IndexError):
            return None

    return texts.map(one, na_action="ignore")


_HLS = T.StructType(
    [
        T.StructField("kind", T.StringType()), T.StructField("uri", T.StringType()), T.StructField("bandwidth", T.LongType()),
        T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("duration", T.DoubleType()),
    ]
)


@F.pandas_udf(_HLS)
def hls(texts: pd.Series) -> pd.DataFrame:
    """First variant of a master list, or first segment of a media list; kind is null for neither."""

    def one(text: str | None) -> tuple:
        lines = [x.strip() for x in (text or "").splitlines() if x.strip()]
        none = (None,) * 6
        if not lines or lines[0] != "#EXTM3U":
            return none
        for i, line in enumerate(lines[:-1]):
            if lines[i + 1].startswith("#"):  # a tag, not the address that the line before it announces
                continue
            if line.startswith("#EXT-X-STREAM-INF:"):
                found = dict(re.findall(r'([A-Z0-9-]+)=("[^"]*"|[^,]*)', line))
                width, _, height = found.get("RESOLUTION", "").partition("x")
                number = lambda x: int(x) if x.isdigit() and int(x) > 0 else None
                return "master", lines[i + 1], number(found.get("BANDWIDTH", "")), number(width), number(height), None
            if line.startswith("#EXTINF:") and any(x.startswith(("#EXT-X-TARGETDURATION:", "#EXT-X-MEDIA-SEQUENCE:")) for x in lines):
                length = re.match(r"[0-9.]+", line[8:])
                if length and float(length[0]) > 0:
                    return "media", lines[i + 1], None, None, None, float(length[0])
        return none

    return pd.DataFrame([one(x) for x in texts], columns=["kind", "uri", "bandwidth", "width", "height", "duration"])
