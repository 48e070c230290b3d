"""Text expressions: blanks, masking, classification, versions, times."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: patterns, names and codes that results must share -------------------------
EMAIL = r"(?i)\b[A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,}\b"
BEARER = r"(?i)\bBearer\s+[A-Za-z0-9._~+/=\-]{8,}"
API_KEY = r"\bsk-[A-Za-z0-9_\-]{8,}\b"
ACCESS_KEY = r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b"
CN_ID = r"(^|[^0-9.])([0-9]{17}[0-9Xx])([^0-9]|$)"
PHONE = r"\b1[3-9][0-9]{9}\b"
PHONE_SPACED = r"\b1[3-9][0-9]{2}[ -]?[0-9]{4}[ -]?[0-9]{4}\b"
LANDLINE = r"\b0[0-9]{2,3}[ -]?[0-9]{7,8}\b"
PERSON = r"(?:(?:姓名|名字|联系人|收件人|客户|患者)\s*[:：]\s*\p{IsHan}{2,4}|我叫\s*\p{IsHan}{2,4})"
ADDRESS = r"(?:地址|住址|收货地址|家庭住址|工作地址)\s*[:：]?\s*[^,，;；。\n]{4,80}"
#: The order in which free text is masked; the identity card comes last, with what stands around it.
MASKED_PATTERNS = [EMAIL, PHONE, PHONE_SPACED, LANDLINE, BEARER, API_KEY, ACCESS_KEY, PERSON, ADDRESS]
ENVIRONMENT = r"(?i)(?:/[a-z0-9_.-]+/|[a-z]:\\|localhost|127\.0\.0\.1|:[0-9]{2,5}\b|\.[a-z0-9]{1,8}\b)"
TOOL_STATUSES = {
    "success": ["success", "succeeded", "completed", "complete", "ok"],
    "error": ["error", "errored", "failed", "failure"],
    "cancelled": ["cancel", "cancelled", "canceled"],
    "timeout": ["timeout", "timed_out"],
}
TERMINAL_STATUSES = {
    "completed": ["success", "succeeded", "completed", "complete", "ok"],
    "failed": ["error", "errored", "failed", "failure"],
    "cancelled": ["cancel", "cancelled", "canceled", "abort", "aborted", "abandoned"],
    "terminated": ["terminate", "terminated", "closed"],
}
MASK, BASE64_MASK = "<|mask_privacy|>", "<base64-excluded>"
INJECTION = (
    r"(?i)(?:\b(?:ignore|disregard|override)\s+(?:all\s+)?(?:the\s+)?(?:previous|prior|above|system|developer)\s+instructions?\b"
    r"|\b(?:jailbreak|do\s+anything\s+now|dan\s+mode|prompt\s+injection)\b"
    r"|\b(?:reveal|show|print|exfiltrate)\s+(?:the\s+)?(?:system|developer)\s+prompt\b"
    r"|忽略(?:之前|以上|上面)的(?:所有)?(?:指令|提示)|无视(?:系统|开发者)(?:提示|指令)|提示词注入|越狱模式)"
)
START_EVENTS = ["session_start", "session_started", "task_start", "task_started"]
TERMINAL_EVENTS = [
    "session_end", "session_ended", "task_end", "task_ended", "task_completed", "cancel",
    "cancelled", "canceled", "terminated", "abort", "aborted", "abandoned",
]
TERMINAL_PREFIXES = ["session_cancel", "task_cancel", "session_fail", "task_fail"]
#: Ordered: the first code one of whose phrases occurs is the reason.
REASON_RULES = [
    ("invalid_lifecycle", ["lifecycle", "conflicting duplicate outcome", "conflicting duplicate status"]),
    ("identity_conflict", ["conflicting", "identity conflict", "duplicate context"]),
    ("missing_identity", ["missing session", "requires session", "missing turn", "requires turn", "conversation.id", "turn.id", "session_id", "turn_id"]),
    ("unsupported_event", ["unsupported", "unknown event"]),
    ("invalid_attributes", ["attribute", "metadata"]),
    ("invalid_tool", ["tool"]),
    ("invalid_lifecycle", ["lifecycle", "status"]),
    ("invalid_timestamp", ["timestamp", "occurred_at"]),
    ("invalid_structure", ["structure", "must be an object", "must be an array", "must contain", "invalid json"]),
]
MODEL_VERSIONS = {
    "gpt": r"(?i)gpt[-_ ]?(\d+)(?:[._-](\d+))?",
    "claude": r"(?i)(?:claude|sonnet|opus)[-_ ]?(\d+)(?:[._-](\d+))?",
    "deepseek": r"(?i)deepseek[-_ ]?(?:v)?(\d+)(?:[._-](\d+))?",
    "glm": r"(?i)glm[-_ ]?(\d+)(?:[._-](\d+))?",
    "kimi": r"(?i)(?:kimi[-_ ]?)?k[-_ ]?(\d+)(?:[._-](\d+))?",
}
TRACEPARENT = r"^([0-9a-fA-F]{2})-([0-9a-fA-F]{32})-([0-9a-fA-F]{16})-([0-9a-fA-F]{2})$"
# ---------------------------------------------------------------------------------------------

def present(c: Column) -> Column:
    """Blank counts as missing."""
    return F.when(F.trim(c) != "", c)


def mask_patterns(c: Column, mask: str = MASK) -> Column:
    """P12 on free text: every secret or personal pattern becomes the mask."""
    plain = mask.replace("\\", r"\\").replace("$", r"\$")
    for p in MASKED_PATTERNS:
        c = F.regexp_replace(c, p, plain)
    return F.regexp_replace(c, CN_ID, f"$1{plain}$3")


def is_injection(c: Column) -> Column:
    """P13."""
    return F.coalesce(c.rlike(INJECTION), F.lit(False))


def scrub_base64(c: Column) -> tuple[Column, Column]:
    """P14 on strings: data urls (``;base64,`` in any case within 128 bytes) are cut; also the bytes that went, those of the payload."""
    cut = F.instr(F.lower(F.substring(c.cast("binary"), 1, 128).cast("string")), ";base64,") > 0
    at = F.instr(c, ";base64,")
    payload = F.when(at > 0, F.substring(c, at + 8, F.length(c))).otherwise(c)
    return F.when(cut, F.lit(BASE64_MASK)).otherwise(c), F.when(cut, F.octet_length(payload)).otherwise(0).cast("long")


def has_environment_signal(c: Column) -> Column:
    """Whether a text names a path, host, port or file ending."""
    return F.coalesce(c.rlike(ENVIRONMENT), F.lit(False))


def normal_event(c: Column) -> Column:
    """Trimmed, lowered, separators to underscores."""
    return F.translate(F.lower(F.trim(c)), "-. :", "____")


def boundary(c: Column) -> Column:
    """``start``, ``terminal`` or null of an event name."""
    e = normal_event(c)
    terminal = reduce(lambda a, p: a | e.startswith(p), TERMINAL_PREFIXES, e.isin(TERMINAL_EVENTS))
    return F.when(e.isin(START_EVENTS), "start").when(terminal, "terminal")


def reason_code(c: Column) -> Column:
    """A fixed code for an error text; the order of the rules decides."""
    low, out = F.lower(c), None
    for code, phrases in REASON_RULES:
        hit = reduce(lambda a, b: a | b, [F.contains(low, F.lit(p)) for p in phrases])
        out = F.when(hit, code) if out is None else out.when(hit, code)
    return out.otherwise("conversion_error")


def protocol_shape(path: Column, request: Column, response: Column, streamed: Column | None = None, kind: Column | None = None) -> Column:
    """P10: struct (family, endpoint, transport) of a call; bodies are JSON or SSE text, ``streamed`` and ``kind`` what the capture says itself. Order is semantic."""
    low, req, res = F.lower(F.coalesce(path, F.lit(""))), F.try_parse_json(request), F.try_parse_json(response)
    has = lambda v, k: F.coalesce(~F.isnull(F.try_variant_get(v, f"$.{k}", "variant")), F.lit(False))
    body = F.coalesce(response, F.lit(""))
    sse = body.rlike(r"(?m)^\s*data:")
    stream = F.coalesce(F.try_variant_get(req, "$.stream", "boolean"), F.lit(False)) | sse
    if streamed is not None:
        stream = stream | F.coalesce(streamed, F.lit(False))
    if kind is not None:
        stream = stream | F.coalesce(kind == "sse", F.lit(False))
    anthropic = F.contains(low, F.lit("/v1/messages")) | F.contains(low, F.lit("anthropic")) | has(req, "anthropic_version") | has(req, "system") | body.contains("message_start") | body.contains("content_block_start")
    chat = F.contains(low, F.lit("chat/completions")) | has(res, "choices")
    responses = low.endswith("/responses") | has(req, "input") | has(res, "output") | body.contains("response.created") | body.contains("response.completed")
    endpoint = F.when(anthropic, "messages").when(chat, "chat_completions").when(responses, "responses").otherwise("unknown")
    return F.struct(F.when(anthropic, "anthropic").otherwise("openai").alias("family"), endpoint.alias("endpoint"), F.when(stream, "stream").otherwise("non_stream").alias("transport"))


def traceparent(c: Column) -> Column:
    """Struct (trace_id, parent_span_id, flags), null where malformed, of version ff or all zero."""
    c = F.lower(F.trim(c))
    part = lambda k: F.regexp_extract(c, TRACEPARENT, k)
    ok = c.rlike(TRACEPARENT) & (part(1) != "ff") & (part(2) != "0" * 32) & (part(3) != "0" * 16)
    return F.when(ok, F.struct(part(2).alias("trace_id"), part(3).alias("parent_span_id"), part(4).alias("flags")))


def model_version(c: Column) -> Column:
    """Struct (vendor, major, minor) of a model name; comparable as a struct within a vendor."""
    out = F.lit(None).cast("struct<vendor:string,major:int,minor:int>")
    for vendor, p in reversed(MODEL_VERSIONS.items()):
        minor = F.coalesce(F.regexp_extract(c, p, 2).try_cast("int"), F.lit(0))
        found = F.struct(F.lit(vendor).alias("vendor"), F.regexp_extract(c, p, 1).try_cast("int").alias("major"), minor.alias("minor"))
        out = F.when(c.rlike(p), found).otherwise(out)
    return out


def header_map(headers: Column, keep: list[str], redact: list[str]) -> Column:
    """A map of lowered header names, only those kept, redacted where told to. Of two spellings of a name the later one counts."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    low = F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(entries, lambda e: e["key"] == n), -1)["value"]))
    kept = F.map_filter(low, lambda k, _: k.isin(keep))
    return F.transform_values(kept, lambda k, v: F.when(k.isin(redact), "[REDACTED]").otherwise(v))


def chain_members(c: Column) -> Column:
    """A comma chain: the whole, and each member."""
    whole = F.trim(c)
    members = F.filter(F.transform(F.split(whole, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(whole == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(F.array(whole), members)))


def ts_nanos(c: Column) -> Column:
    """RFC 3339 text with up to nine fraction digits, or decimal nanoseconds, to DECIMAL(20,0) nanoseconds."""
    fraction = F.rpad(F.regexp_extract(c, r"\.(\d{1,9})", 1), 9, "0")
    seconds = F.unix_seconds(F.try_to_timestamp(F.regexp_replace(c, r"\.\d+", "")))
    rfc = seconds.cast("decimal(20,0)") * F.lit(10**9).cast("decimal(10,0)") + fraction.cast("decimal(20,0)")
    return F.when(c.rlike(r"^\d+$"), c.cast("decimal(20,0)")).otherwise(rfc).cast("decimal(20,0)")


def local_time(ts: Column, offset_minutes: int = 480) -> Column:
    """At a fixed offset from UTC; no zone with summer time."""
    return F.timestamp_add("MINUTE", F.lit(offset_minutes), ts)


def ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    return F.when(b == 0, F.lit(empty)).otherwise(a / b)


def fingerprint(c: Column) -> Column:
    """SHA-256 of JSON in canonical form (sorted keys, compact)."""
    return F.sha2(F.to_json(F.parse_json(c)), 256)


def stable_id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix + "-"), F.sha2(F.concat_ws("\0", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256))


def _status(c: Column, names: dict[str, list[str]], rest: str) -> Column:
    low, out = F.lower(F.trim(c)), F.lit(rest)
    for status, words in names.items():
        out = F.when(low.isin(words), status).otherwise(out)
    return out


def tool_status(c: Column) -> Column:
    """A tool's status: success, error, cancelled, timeout or unknown."""
    return _status(c, TOOL_STATUSES, "unknown")


def terminal_status(c: Column) -> Column:
    """A session's or node's last status: completed, failed, cancelled, terminated or incomplete."""
    return _status(c, TERMINAL_STATUSES, "incomplete")


def process_header(c: Column) -> Column:
    """Struct (state, exit_code, session_id, success) of a process report, or null.

    Only lines above the first that is ``Output:`` count; there must be such
    a line, a wall time above it, and exactly one outcome.
    """
    lines = F.split(c, r"\r?\n")
    end = F.array_position(lines, "Output:")
    head = F.when(end > 0, F.slice(lines, 1, (end - 1).cast("int")))
    numbers = lambda pattern, kind: F.array_compact(F.transform(F.filter(head, lambda x: x.rlike(pattern)), lambda x: F.regexp_extract(x, pattern, 1).try_cast(kind)))
    codes, ids = numbers(r"^Process exited with code ([+-]?\d+)$", "int"), numbers(r"^Process running with session ID ([+-]?\d+)$", "long")
    timed = F.exists(head, lambda x: x.startswith("Wall time: ") & x.endswith(" seconds"))
    exited, code = F.size(codes) == 1, F.get(codes, 0)
    found = F.struct(F.when(exited, "exited").otherwise("running").alias("state"), code.alias("exit_code"), F.get(ids, 0).alias("session_id"), F.when(exited, code == 0).alias("success"))
    return F.when(timed & (F.size(codes) + F.size(ids) == 1), found)


def prefix_bytes(c: Column, most: int) -> Column:
    """The longest prefix of at most ``most`` UTF-8 bytes that cuts no character."""
    raw = F.substring(c.cast("binary"), 1, most)
    back = F.array(*[F.substring(c.cast("binary"), 1, most - k) for k in range(min(4, most + 1))])
    whole = F.filter(back, lambda x: F.is_valid_utf8(x.cast("string")))
    return F.when(F.octet_length(c) <= most, c).otherwise(F.coalesce(F.get(whole, 0), raw).cast("string"))


def without_controls(c: Column, most: int = 160, otherwise: str = "<unnamed>") -> Column:
    """A name for diagnostics: longer ones, and those with control characters, give way to a placeholder."""
    return F.when((F.octet_length(c) <= most) & ~c.rlike(r"\p{Cc}"), c).otherwise(otherwise)


def started_at(finished: Column, duration_ms: Column) -> Column:
    """The time that a duration before another was."""
    return F.timestamp_millis(F.unix_millis(finished) - duration_ms)


def period(ts: Column, kind: str) -> Column:
    """Struct (start, end): the day, week (from Monday), month or year that holds a time, the end exclusive."""
    start = F.date_trunc(kind, ts)
    months = {"month": 1, "year": 12}
    after = F.timestamp_add("MONTH", F.lit(months[kind]), start) if kind in months else F.timestamp_add("DAY", F.lit(7 if kind == "week" else 1), start)
    return F.struct(start.alias("start"), after.alias("end"))


def safe_identifier(c: Column) -> Column:
    return c.rlike(r"^[A-Za-z0-9._-]{1,128}$") & ~c.rlike(r"^\.+$")
