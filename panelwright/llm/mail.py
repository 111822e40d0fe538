"""A sender's own writing in a raw mail.

Headers, attachments, markup, quoted mail, greeting, signature, sign-off and disclaimer go; what
is left is what the sender wrote.  Texts without a header block are bodies.
"""

from __future__ import annotations

import base64
import binascii
import html
import quopri
import re

_HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*:(?:[ \t]|\r?$)")
_BOUNDARY = re.compile(r'boundary="?([^";\r\n]+)', re.I)
_CHARSET = re.compile(r'charset="?([\w.:-]+)', re.I)
_ROW_END = re.compile(r"\s*<(?:/tr|/p|/div|/li|/h\d|/table|/ul|/ol|br ?/?)\s*>\s*?\n?", re.I)
_CELL_END = re.compile(r"\s*</t[dh]>\s*(?=<t[dh])", re.I)
_QUOTE = re.compile(r"<blockquote.*?</blockquote>", re.I | re.S)
_SKIPPED = re.compile(r"<(style|script|head)\b.*?</\1>|<!--.*?-->", re.I | re.S)
_TAG = re.compile(r"</?[A-Za-z!][^<>]*>")
_ITEM = re.compile(r"<li[^<>]*>", re.I)

#: Words of the four languages by which mail programs and writers mark parts of a mail.
_ATTRIBUTION = re.compile(r"\s*(?:On|Am|El|Le)\b.{0,200}(?:wrote|schrieb\b.*|escribió|a écrit)\s*:\s*$")
_FORWARD = re.compile(r"\s*-{2,}\s*(?:Original Message|Ursprüngliche Nachricht|Mensaje original|Message d'origine|Forwarded message|Weitergeleitete Nachricht|Mensaje reenviado|Message transféré)\s*-{2,}", re.I)
_GREETING = re.compile(
    r"(?:(?:hello|hi|dear|hallo|hola|bonjour|liebe[r]?|cher|chère|querid[oa]|estimad[oa])\b.{0,40}[,:!-]|good (?:morning|afternoon|evening)[,!]"
    r"|guten (?:tag|morgen|abend)[,!]|sehr geehrte.{0,60}[,:]|buen[oa]s (?:días|tardes|noches)[,:!]|estimados .{0,30}[,:]|chers collègues,|madame, monsieur,|[^\W\d_][\w'-]{1,20}(?: [^\W\d_][\w'-]{1,20})? -)\s*$",
    re.I,
)
_SIGNOFF = re.compile(
    r"(?:kind regards|best regards|regards|best|thanks|thank you|cheers|yours sincerely|sincerely|yours|viele grüße|mit freundlichen grüßen|liebe grüße|beste grüße|gruß"
    r"|saludos|un abrazo|un saludo|atentamente|cordialement|bien à vous|amicalement|merci)\s*[,.!]?\s*$",
    re.I,
)
_DISCLAIMER = re.compile(
    r"\W*(?:confidentiality notice|please think of the trees|this communication is privileged|communication is privileged|the views in this mail|this e-?mail may contain|this message and any"
    r"|diese nachricht ist vertraulich|este mensaje es confidencial|ce message est confidentiel)",
    re.I,
)


#: Fields that may open a mail's or a part's header block.
_FIELDS = frozenset(
    "received from to cc bcc subject date message-id in-reply-to references reply-to sender return-path delivered-to mime-version"
    " content-type content-transfer-encoding content-disposition content-id content-description x-mailer user-agent x-priority importance list-id".split()
)


def _headers(text: str) -> tuple[dict[str, str], str]:
    """Header fields in lower case, and the body; no fields if the text starts without a header.

    A block opens with a field of mail; other ``Name: value`` lines are writing.  It ends at
    the first blank line, or at the first line that is no field.
    """
    m = _HEADER.match(text)
    if not m or m.group(0).split(":", 1)[0].lower() not in _FIELDS:
        return {}, text
    at = text.find("\n\n")
    other = text.find("\n\r\n")
    end = min(x for x in (at, other, len(text)) if x >= 0)
    fields: dict[str, str] = {}
    last, used = "", 0
    for line in text[:end].split("\n"):
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif _HEADER.match(line):
            last, value = line.split(":", 1)
            last = last.lower()
            fields[last] = value.strip()
        else:
            return fields, text[used:]
        used += len(line) + 1
    return fields, text[end:].lstrip("\r\n") if end < len(text) else ""


def _decoded(fields: dict[str, str], body: str) -> str:
    how = fields.get("content-transfer-encoding", "").lower()
    if "quoted" not in how and "base64" not in how:
        return body
    m = _CHARSET.search(fields.get("content-type", ""))
    charset = m.group(1) if m else "utf-8"
    try:
        if "quoted" in how:
            raw = quopri.decodestring(body.encode("utf-8", "surrogatepass"))
        else:
            raw = base64.b64decode(re.sub(r"[^A-Za-z0-9+/]", "", body) + "===")
        return raw.decode(charset, "replace")
    except (LookupError, ValueError, binascii.Error):
        return body


def plain_html(text: str) -> str:
    """Lines of an HTML text: rows and items are lines, cells are parted by tabs."""
    text = _QUOTE.sub("\n", _SKIPPED.sub("", text))
    text = _ITEM.sub("\n* ", _ROW_END.sub("\n", _CELL_END.sub("\t", text)))
    return html.unescape(_TAG.sub("", text))


def _parts(fields: dict[str, str], body: str, depth: int, plain: list[str], rich: list[str]) -> None:
    kind = fields.get("content-type", "text/plain").lower()
    if kind.startswith("multipart") and depth < 8:
        m = _BOUNDARY.search(fields["content-type"])
        if m:
            for segment in ("\n" + body).split("\n--" + m.group(1).strip())[1:]:
                if segment.startswith("--"):
                    break
                segment = segment.lstrip("\r\n")
                inner, rest = _headers(segment)
                _parts(inner, rest, depth + 1, plain, rich)
            return
    if "attachment" in fields.get("content-disposition", "").lower():
        return
    if kind.startswith("text/html"):
        rich.append(plain_html(_decoded(fields, body)))
    elif kind.startswith("text/") or kind.startswith("multipart") or "content-type" not in fields:
        plain.append(_decoded(fields, body))


def body_of(text: str) -> str:
    """The readable body: plain text parts, or else the HTML part as text."""
    fields, body = _headers(text)
    plain: list[str] = []
    rich: list[str] = []
    _parts(fields, body, 0, plain, rich)
    found = "\n".join(p for p in plain if p.strip()) or "\n".join(rich)
    if "<table" in found or "<td" in found or "<li" in found or "<br" in found:
        found = plain_html(found)
    return found


def own_writing(text: str) -> str:
    """Lines of the sender's own writing; blank lines between paragraphs are kept."""
    out: list[str] = []
    state = ""  # quote: a block after an attribution; sign: below a sign-off; note: a disclaimer
    started = False
    lines = body_of(text).split("\n")
    for i, line in enumerate(lines):
        line = line.rstrip("\r")
        s = line.strip()
        if not s:
            if state in ("note", "sign"):
                state = ""
            if out and out[-1]:
                out.append("")
            continue
        if s == "--" and line.startswith("--"):
            state = "tail"
            continue
        if s[0] == ">" or (state == "quote" and s[0] == "|"):
            if state not in ("quote", "tail"):
                state = ""
            continue
        if _FORWARD.match(line):
            break
        if len(s) < 260 and s.endswith(":") and _ATTRIBUTION.match(s):
            state = "quote"
            continue
        if state == "tail":
            continue
        if state == "quote":
            state = ""
        if _DISCLAIMER.match(s) or (s == "This" and i + 1 < len(lines) and _DISCLAIMER.match(lines[i + 1])):
            state = "note"
        if state in ("note", "sign"):
            continue
        if len(s) < 60 and _SIGNOFF.match(s):
            state = "sign"
            continue
        if not started and len(s) < 70 and _GREETING.match(s):
            started = True
            continue
        started = True
        out.append(line)
    while out and not out[-1]:
        out.pop()
    return "\n".join(out)
