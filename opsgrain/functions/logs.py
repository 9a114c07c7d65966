"""Severity, event type, class and time handling for log lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsgrain import rules
from opsgrain.functions.core import as_col, first_match, keyword_any, lookup, strip


def lowered(*cols: Column | str) -> Column:
    """The texts in lower case, joined by one blank; compute it once and pass it on."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(as_col(c), F.lit("")) for c in cols]))


def severity_by_keywords(
    low: Column,
    error_keywords: Sequence[str] = rules.LINUX_ERROR_KEYWORDS,
    warn_keywords: Sequence[str] = rules.LINUX_WARN_KEYWORDS,
) -> Column:
    """Severity from a lower-case message; error words win."""
    return first_match(
        [(keyword_any(low, error_keywords), "ERROR"), (keyword_any(low, warn_keywords), "WARN")],
        "INFO",
    )


def severity_hpc(state: Column | str, flag: Column | str, low: Column) -> Column:
    s = lowered(state)
    flagged = F.coalesce(strip(flag), F.lit("")) == "1"
    error = keyword_any(s, rules.HPC_STATE_ERROR) | flagged | keyword_any(low, rules.HPC_MESSAGE_ERROR)
    warn = keyword_any(s, rules.HPC_STATE_WARN) | keyword_any(low, rules.HPC_MESSAGE_WARN)
    return first_match([(error, "ERROR"), (warn, "WARN")], "INFO")


def severity_by_level(
    level: Column | str, low: Column, error_keywords: Sequence[str], warn_keywords: Sequence[str],
) -> Column:
    """The level decides; an unknown level falls back to the message keywords."""
    mapped = lookup(F.upper(strip(level)), rules.LEVEL_MAP)
    return F.coalesce(mapped, severity_by_keywords(low, error_keywords, warn_keywords))


def event_type(low: Column, severity: Column | str) -> Column:
    """First matching rule over the lower-case message and template."""
    quiet = F.when(as_col(severity) == "INFO", F.lit("normal_ops")).otherwise(F.lit("unknown"))
    return first_match([(keyword_any(low, kws), name) for name, kws in rules.EVENT_TYPE_RULES], quiet)


def event_class(kind: Column | str, template: Column | str) -> Column:
    """Class 0..6 by event type; template keywords override the map."""
    low = F.lower(F.coalesce(as_col(template), F.lit("")))
    override = [(keyword_any(low, kws), cls) for cls, kws in rules.EVENT_CLASS_OVERRIDES]
    return first_match(override, F.coalesce(lookup(as_col(kind), rules.EVENT_CLASSES), F.lit(0)))


def event_int(event_id: Column | str) -> Column:
    """Digits of ``E<digits>``; null marks an id that a quality gate has to report."""
    return F.nullif(F.regexp_extract(as_col(event_id), r"E(\d+)", 1), F.lit("")).try_cast("int")


def time_bucket(timestamp: Column | str, system: Column | str) -> Column:
    """Minute-like bucket cut from the text of the timestamp, per system layout."""
    ts, sys = strip(as_col(timestamp).cast("string")), as_col(system)
    pair = r"^([^\s]+)\s+([^\s]{1,4})[^\s]*$"
    hdfs = F.when(ts.rlike(pair), F.regexp_replace(ts, pair, "$1 $2")).otherwise(F.substring(ts, 1, 9))
    # the last word keeps its first two colon parts; decimal commas in it become points
    cut = F.regexp_replace(ts, r"(?s)^(.*) ([^: ]*(?::[^: ]*)?)(?::[^ ]*)?$", "$1 $2")
    minute = F.regexp_replace(cut, r",(?=[^ ]*$)", ".")
    return first_match(
        [(sys == "hpc", F.substring(ts, 1, 7)), (sys == "hdfs", hdfs), (ts.contains(" "), minute)],
        F.substring(ts, 1, 10),
    )


# fixed values: month names of syslog lines, three letters each
_MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"

# fixed values: layouts and their ISO form; two-digit years from 69 on are in the last century
_LAYOUTS = (
    (r"^\s*([0-5]\d|6[0-8])(\d\d)(\d\d) +(\d\d)(\d\d)(\d\d)\s*$", "20$1-$2-$3 $4:$5:$6"),
    (r"^\s*(69|[7-9]\d)(\d\d)(\d\d) +(\d\d)(\d\d)(\d\d)\s*$", "19$1-$2-$3 $4:$5:$6"),
    (r"^\s*([0-5]\d|6[0-8])/(\d\d)/(\d\d) +(\d\d:\d\d:\d\d)\s*$", "20$1-$2-$3 $4"),
    (r"^\s*(69|[7-9]\d)/(\d\d)/(\d\d) +(\d\d:\d\d:\d\d)\s*$", "19$1-$2-$3 $4"),
    (r"^\s*(\d{4}-\d\d-\d\d) +(\d\d:\d\d:\d\d)(?:[,.](\d+))?\s*$", "$1 $2.$3"),
)
_SYSLOG = r"^\s*([A-Z][a-z]{2}) +(\d{1,2}) +(\d\d:\d\d:\d\d)\s*$"


def parse_event_ts(timestamp: Column | str) -> Column:
    """Timestamp without zone: epoch seconds, ``MMM d HH:mm:ss`` (year 1900) or one of the
    documented layouts; anything else is null.

    The layouts are rewritten to ISO text one after the other (a text that does not match
    passes through) and cast once, which needs no session time zone.
    """
    ts = as_col(timestamp)
    text = ts
    for pattern, target in _LAYOUTS:
        text = F.regexp_replace(text, pattern, target)
    month = F.floor((F.instr(F.lit(_MONTHS), F.regexp_extract(ts, _SYSLOG, 1)) + 2) / 3)
    syslog = F.concat(F.lit("1900-"), month.cast("string"), F.lit("-"), F.regexp_replace(ts, _SYSLOG, "$2 $3"))
    seconds = F.when(ts.rlike(r"^\s*[+-]?\d+(\.\d+)?\s*$"), ts).try_cast("double")
    epoch = F.timestamp_add("SECOND", F.floor(seconds).cast("bigint"),
                            F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    iso = F.when(ts.rlike(_SYSLOG), syslog).when(seconds.isNull(), text)
    return F.coalesce(epoch, iso.try_cast("timestamp_ntz"))
