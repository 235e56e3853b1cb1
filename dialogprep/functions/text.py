"""Message-text rules as Spark column expressions (no Python UDFs).

Each function maps ``Column -> Column`` so it runs inside whole-stage codegen
and composes with ``select``/``where``/``withColumn``.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the behaviour being reproduced.
# ---------------------------------------------------------------------------

# Platform-event phrases; a message whose lower-cased raw text contains any of
# them is dropped whole.
PLATFORM_NOISE = (
    "reacted",
    "liked your message",
    "sent a photo",
    "shared a link",
    "wasn't notified about this message because they're in quiet mode",
    "sent an attachment",
    "liked a message",
    "changed the theme",
    "@meta ai",
    "shared a story",
    "sent a reel",
    "video call",
    "missed call",
    "sent a post",
    "think of me like an assistant who's here to help",
    "started an audio call",
    "audio call ended",
)

# Phone-number pattern, written with Python's \d and \s.
PHONE_PATTERN_PY = r"\+?\d{1,4}[\s-]?\(?\d{1,4}\)?[\s-]?\d{1,4}[\s-]?\d{1,4}[\s-]?\d{1,9}"
PHONE_TOKEN = "[PHONE_NUMBER]"

MIN_LENGTH = 2
MAX_LENGTH = 1000

# Code points Python's str.strip() / str.isspace() / re's \s treat as white
# space (U+200B is not one of them).
PY_WHITESPACE_CODEPOINTS = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)

# ---------------------------------------------------------------------------

PY_WHITESPACE = "".join(chr(c) for c in PY_WHITESPACE_CODEPOINTS)

# Java regex classes equal to Python's Unicode \s and \d. Java's own \s and \d
# are ASCII-only, and even (?U) misses U+001C..U+001F.
JAVA_WS_CLASS = "".join(f"\\x{{{c:X}}}" for c in PY_WHITESPACE_CODEPOINTS)
JAVA_DIGIT = r"\p{Nd}"

# The phone pattern with the Unicode classes spelled out, for Java regex.
PHONE_PATTERN = (
    r"\+?{d}{{1,4}}[{ws}-]?\(?{d}{{1,4}}\)?[{ws}-]?{d}{{1,4}}[{ws}-]?{d}{{1,4}}[{ws}-]?{d}{{1,9}}"
).format(d=JAVA_DIGIT, ws=JAVA_WS_CLASS)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """``str.strip()``: trim the 29 Unicode white-space code points."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def noise_phrases(extra_noise: Iterable[str] | None = None) -> list[str]:
    """Default phrases plus caller phrases, lower-cased like the defaults."""
    more = [p.lower() for p in extra_noise or ()]
    if "" in more:
        raise ValueError("an empty noise phrase would drop every message")
    return [*PLATFORM_NOISE, *more]


def is_noise(c: Column | str, extra_noise: Iterable[str] | None = None, lowered: Column | None = None) -> Column:
    """True when the lower-cased text contains any noise phrase (substring).

    Substring semantics on purpose: "reacted" also matches "overreacted". A
    chain of ``contains`` is a byte search per phrase inside codegen, cheaper
    than one alternation regex. ``lowered`` may pass an already lower-cased
    column.
    """
    if lowered is None:
        lowered = F.lower(_col(c))
    cond = F.lit(False)
    for phrase in noise_phrases(extra_noise):
        cond = cond | lowered.contains(phrase)
    return cond


def repair_mojibake(c: Column | str) -> Column:
    """Undo UTF-8 bytes that were decoded as Latin-1.

    Re-encode as Latin-1 and decode as strict UTF-8; any failure keeps the
    text. Spark's ``encode`` raises on characters above U+00FF, so such texts
    are routed around it; ``try_validate_utf8`` returns null on bad bytes.
    """
    c = _col(c)
    redecoded = F.try_validate_utf8(F.encode(c, "ISO-8859-1").cast("string"))
    return F.when(c.rlike("[^\\x00-\\xFF]"), c).otherwise(F.coalesce(redecoded, c))


def within_length(c: Column | str, min_length: int = MIN_LENGTH, max_length: int = MAX_LENGTH) -> Column:
    """Inclusive bounds on the number of code points."""
    return F.length(_col(c)).between(min_length, max_length)


def _quote_regex(term: str) -> str:
    """Literal Java-regex form of ``term`` (\\Q..\\E, with \\E inside split)."""
    return "\\Q" + term.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _quote_replacement(token: str) -> str:
    """Literal Java replacement string: escape \\ and $."""
    return token.replace("\\", "\\\\").replace("$", "\\$")


CHAINED_SECRETS = 32  # phrases; longer lists are folded over an array


def _any_regex(terms: Iterable[str]) -> str:
    """Java regex that finds a text holding any of the terms, as a prefix tree:
    a position costs its possible next characters, not the number of terms."""

    def branch(ordered: list[str], at: int) -> str:
        """Of sorted terms that agree before ``at``."""
        out, i = [], 0
        while i < len(ordered):
            j = i
            while j < len(ordered) and ordered[j][at] == ordered[i][at]:
                j += 1
            first, last = ordered[i], ordered[j - 1]  # what they share, all between share
            end = at + 1
            while end < len(first) and end < len(last) and first[end] == last[end]:
                end += 1
            rest = "" if len(first) == end else branch(ordered[i:j], end)
            out.append(_quote_regex(first[at:end]) + rest)
            i = j
        return f"(?:{'|'.join(out)})"

    distinct = sorted(set(terms))
    return "(?iu)" + ("" if distinct[0] == "" else branch(distinct, 0))  # the empty term is everywhere


def replace_secrets(c: Column | str, secrets: Sequence[tuple[str, str]]) -> Column:
    """Replace each phrase with its token, case-insensitively, in list order.

    Later entries see the output of earlier ones. Phrases and tokens are
    literal (tokens are not regex templates). Up to ``CHAINED_SECRETS`` phrases
    are nested calls; more are one fold over a constant array, which only
    texts holding any phrase enter.
    """
    out = _col(c)
    quoted = [("(?iu)" + _quote_regex(term), _quote_replacement(token)) for term, token in secrets]
    if len(quoted) <= CHAINED_SECRETS:
        for pattern, token in quoted:
            out = F.regexp_replace(out, pattern, token)
        return out
    table = json.dumps([{"p": pattern, "t": token} for pattern, token in quoted])
    steps = F.from_json(F.lit(table), "array<struct<p:string,t:string>>")
    any_phrase = _any_regex(term for term, _ in secrets)

    def folded(text: Column) -> Column:
        return F.aggregate(steps, text, lambda now, x: F.regexp_replace(now, x["p"], x["t"]))

    # as an element of an array the text is computed once
    return F.transform(F.array(out), lambda text: F.when(text.rlike(any_phrase), folded(text)).otherwise(text))[0]


def redact_phones(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), PHONE_PATTERN, PHONE_TOKEN)


def scrub(
    c: Column | str,
    secrets: Sequence[tuple[str, str]] = (),
    extra_noise: Iterable[str] | None = None,
    min_length: int = MIN_LENGTH,
    max_length: int = MAX_LENGTH,
) -> Column:
    """Full message scrub; returns NULL for a message to drop.

    Order: empty -> noise on the raw text -> mojibake repair -> strip ->
    length bounds -> secrets -> phones -> strip -> empty. Keep the rows with
    :func:`dialogprep.operators.layout.keep_nonnull`, which computes it once
    per row (a ``where`` on it would compute it twice).
    """
    raw = _col(c)
    return _scrub_parts(raw, F.lower(raw), py_strip(repair_mojibake(raw)), secrets, extra_noise, min_length, max_length)


def _scrub_parts(raw, lowered, decoded, secrets, extra_noise, min_length, max_length, null_if_empty=True) -> Column:
    redacted = py_strip(redact_phones(replace_secrets(decoded, secrets)))
    kept = (
        F.when(raw.isNull() | (raw == ""), F.lit(None))
        .when(is_noise(raw, extra_noise, lowered), F.lit(None))
        .when(~within_length(decoded, min_length, max_length), F.lit(None))
    )
    if null_if_empty:
        kept = kept.when(redacted == "", F.lit(None))
    return kept.otherwise(redacted)


def scrub_staged(
    df,
    c: str,
    out: str,
    secrets: Sequence[tuple[str, str]] = (),
    extra_noise: Iterable[str] | None = None,
    min_length: int = MIN_LENGTH,
    max_length: int = MAX_LENGTH,
):
    """:func:`scrub` of column ``c`` into column ``out``, keeping only the
    rows whose message survives.

    The lower-cased and the repaired text are staged as columns, so each is
    computed once per row (the noise test would otherwise lower-case the text
    once per phrase); the result is kept with an evaluate-once flat-map.
    """
    from dialogprep.operators.layout import keep_nonnull

    staged = df.withColumn("_dp_low", F.lower(F.col(c))).withColumn(
        "_dp_dec", py_strip(repair_mojibake(F.col(c)))
    )
    value = _scrub_parts(
        F.col(c), F.col("_dp_low"), F.col("_dp_dec"), secrets, extra_noise, min_length, max_length, null_if_empty=False
    )
    # The test for an empty result stands above the generator: inside the
    # value it would hold the whole redaction a second time.
    return keep_nonnull(staged, value, out).where(F.col(out) != "").drop("_dp_low", "_dp_dec")


def normalize_sender(c: Column | str, my_name: str, repair: bool = False) -> Column:
    """'me' when ``my_name`` is a case-sensitive substring of the sender.

    The sender is matched as exported (an accented name does not match a
    mis-decoded sender) unless ``repair`` applies :func:`repair_mojibake`
    first.
    """
    check_name(my_name)
    name = F.coalesce(_col(c), F.lit(""))
    if repair:
        name = repair_mojibake(name)
    return F.when(name.contains(my_name), F.lit("me")).otherwise(F.lit("other"))


def party_handle(c: Column | str) -> Column:
    """Display name -> handle: mojibake repair, keep [A-Za-z0-9], lower case.

    An empty result becomes 'other_user'; NULL input stays NULL (meaning no
    other party was found).
    """
    c = _col(c)
    cleaned = F.lower(F.regexp_replace(repair_mojibake(c), "[^a-zA-Z0-9]", ""))
    return F.when(c.isNull(), F.lit(None)).when(cleaned == "", F.lit("other_user")).otherwise(cleaned)


def check_name(my_name: str) -> None:
    """The name decides who wrote a message; a blank one would match all."""
    if (my_name or "").strip() == "":
        raise ValueError("a name is needed to tell the own messages from the others'")
