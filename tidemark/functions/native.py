"""The same encodings, digests and keys as Spark expressions: they stay in the JVM and in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import domains as D


def raw(data: bytes) -> Column:
    return F.unhex(F.lit(data.hex()))


def little(value: Column, size: int) -> Column:
    """A long as size bytes, the lowest first; negative values in two's complement."""
    digits = F.substring(F.lpad(F.hex(value.cast("long")), 16, "0"), 17 - 2 * size, 2 * size)
    return F.unhex(F.concat(*(F.substring(digits, 2 * size - 1 - 2 * k, 2) for k in range(size))))


def u64(value: Column) -> Column:
    """Eight bytes of a decimal(20,0) from 0 to 2**64 - 1."""
    value = value.cast("decimal(20,0)")
    half, whole = (F.lit(str(2**k)).cast("decimal(20,0)") for k in (63, 64))
    return little(F.when(value >= half, value - whole).otherwise(value), 8)


def from_little(data: Column, size: int = 8) -> Column:
    """Bytes, the lowest first, as decimal(20,0)."""
    digits = F.hex(data)
    return F.conv(F.concat(*(F.substring(digits, 2 * size - 1 - 2 * k, 2) for k in range(size))), 16, 10).cast("decimal(20,0)")


def text(value: Column) -> Column:
    """A string's bytes after their number in two bytes; strings over the limit raise."""
    size = F.octet_length(value)
    return F.when(size <= D.MAX_STRING, F.concat(little(size, 2), F.encode(value, "UTF-8"))).otherwise(F.raise_error(F.lit("string too long")).cast("binary"))


def sha(*parts: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hexed(data: Column) -> Column:
    return F.lower(F.hex(data))


TICK = (("time", 8), ("bid_bits", 8), ("ask_bits", 8), ("last_bits", 8), ("volume", 8), ("time_msc", 8), ("flags", 4), ("volume_real_bits", 8))


def record_bytes(columns: dict[str, Column]) -> Column:
    """The 60 bytes of a tick that its fingerprint covers."""
    return F.concat(*(little(columns[name], size) for name, size in TICK))


def fingerprint(record: Column) -> Column:
    """Of the 60 bytes of a tick."""
    return sha(raw(D.PAYLOAD), text(F.lit(D.SCHEMA_ID)), record)


def frame_fingerprint(frame: Column, offset: Column) -> Column:
    """Of the record at a byte offset (from 0) in a batch frame."""
    return fingerprint(F.substr(frame, offset.cast("int") + 1, F.lit(60)))


def observation(producer: Column, session: Column, batch: Column, ordinal: Column, capture: Column, print_: Column) -> Column:
    return sha(raw(D.OBSERVATION), text(producer), text(session), u64(batch), little(ordinal, 4), u64(capture), print_)


def batch_hash(frame: Column) -> Column:
    return sha(raw(D.BATCH), frame)


def entry_hash(sequence: Column, previous: Column, wall_s: Column, mono_us: Column, batch: Column, frame: Column) -> Column:
    return sha(raw(D.WAL_ENTRY), u64(sequence), previous, little(wall_s, 8), u64(mono_us), batch, frame)


def boundary(cursor: Column, previous: Column, prints: Column) -> Column:
    """Over an array of fingerprints in observed order."""
    joined = F.aggregate(prints, raw(b""), lambda a, x: F.concat(a, x))
    return sha(raw(D.BOUNDARY), little(cursor, 8), previous, little(F.size(prints), 4), joined)


def segment_id(scope: list[Column], manifest_key: Column, manifest_sha: Column, sequence: Column, ordinal: Column, code: Column, predecessor: Column) -> Column:
    return hexed(sha(raw(D.SEGMENT), *(text(c) for c in scope), text(manifest_key), manifest_sha, u64(sequence), little(ordinal, 4), text(code), predecessor))


def chain_step(sequence: Column, previous: Column, row: Column) -> Column:
    return sha(raw(D.ROW_CHAIN), u64(sequence), previous, little(F.octet_length(row), 4), row)


def chain_root(rows: Column) -> Column:
    """The last hash of an array of struct(s: sequence, d: bytes), which is put into order first; zero for none."""
    return F.aggregate(F.array_sort(rows), raw(D.ZERO), lambda a, x: chain_step(x["s"], a, x["d"]))


def lease(*identity: Column) -> Column:
    joined = F.concat(raw(D.LEASE), *(part for c in identity for part in (raw(b"\0"), F.encode(c, "UTF-8"))))
    return F.concat(F.lit("lease-"), F.substring(F.sha2(joined, 256), 1, 32))


def identity_key(value: Column) -> Column:
    """SHA-256 of the exact bytes, nothing normalised."""
    return F.sha2(F.encode(value, "UTF-8"), 256)


def raw_object_key(digest: Column) -> Column:
    return F.concat(F.lit("objects/raw/wal-"), digest, F.lit(".rtw"))


def derivative_base(contract: Column, conversion: Column, day_definition: Column, date: Column) -> Column:
    parts = [F.lit("derivatives/stream="), identity_key(contract), F.lit(f"/format={D.FORMAT_ID}/conversion="), identity_key(conversion), F.lit("/day-definition="), identity_key(day_definition), F.lit("/date="), date]
    return F.concat(*parts)


def part_key(base: Column, first: Column, last: Column, digest: Column) -> Column:
    return F.concat(base, F.lit("/parquet/"), first.cast("string"), F.lit("-"), last.cast("string"), F.lit("-"), digest, F.lit(".parquet"))


def part_manifest_key(base: Column, sequence: Column, digest: Column) -> Column:
    return F.concat(base, F.lit("/manifests/part-"), F.lpad(sequence.cast("string"), 8, "0"), F.lit("-"), digest, F.lit(".json"))


def replay_manifest_key(base: Column, revision: Column, digest: Column) -> Column:
    return F.concat(base, F.lit("/replay-day-"), revision.cast("string"), F.lit("-"), digest, F.lit(".json"))


def scope_path_key(provider: Column, symbol: Column) -> Column:
    """Strings with eight bytes of length, unlike text()."""
    part = lambda c: F.concat(little(F.octet_length(c), 8), F.encode(c, "UTF-8"))
    return F.sha2(F.concat(raw(D.SCOPE_KEY), part(provider), part(symbol)), 256)


def utc_day(msc: Column) -> Column:
    """YYYY-MM-DD of milliseconds, floored for negative ones; the session's time zone plays no part."""
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(msc / 86_400_000).cast("int")), "yyyy-MM-dd")


def is_digest(value: Column) -> Column:
    return value.rlike("^[0-9a-f]{64}$")


def is_day(value: Column) -> Column:
    return F.coalesce(F.date_format(F.try_to_timestamp(value, F.lit("yyyy-MM-dd")), "yyyy-MM-dd") == value, F.lit(False))


def is_relative_path(value: Column) -> Column:
    return (F.octet_length(value) <= D.MAX_PATH) & (value != "") & F.forall(F.split(value, "/"), lambda p: (p != "") & (p != ".") & (p != "..")) & ~value.contains("\\")


def zero_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0).cast("long"))


def retry_delay(attempts: Column, least: int, most: int) -> Column:
    """least, doubled with each attempt after the first, up to most."""
    return F.least(F.lit(most), F.lit(least) * F.pow(F.lit(2), F.least(F.greatest(attempts - 1, F.lit(0)), F.lit(40)))).cast("long")


def checked_add(a: Column, b: Column) -> Column:
    """Of decimal(20,0) from 0 to 2**64 - 1; a larger sum raises."""
    total = (a.cast("decimal(38,0)") + b.cast("decimal(38,0)")).cast("decimal(38,0)")
    return F.when(total < F.lit(str(2**64)).cast("decimal(38,0)"), total.cast("decimal(20,0)")).otherwise(F.raise_error(F.lit("sum overflows")).cast("decimal(20,0)"))


def checked_multiply(a: Column, b: Column) -> Column:
    """Of decimal(20,0) from 0 to 2**64 - 1; a larger product raises."""
    limit = F.lit(str(2**64 - 1)).cast("decimal(20,0)")
    whole = F.floor(limit / F.greatest(b.cast("decimal(20,0)"), F.lit(1).cast("decimal(20,0)"))).cast("decimal(20,0)")  # a quotient keeps six places, so what it rounds is below one
    fits = (b == 0) | (a.cast("decimal(20,0)") <= whole)
    return F.when(fits, (a.cast("decimal(20,0)") * b.cast("decimal(20,0)")).cast("decimal(20,0)")).otherwise(F.raise_error(F.lit("product overflows")).cast("decimal(20,0)"))


def saturating_add(a: Column, b: Column) -> Column:
    """The same, but a larger sum is 2**64 - 1."""
    total = (a.cast("decimal(38,0)") + b.cast("decimal(38,0)")).cast("decimal(38,0)")
    return F.least(total, F.lit(str(2**64 - 1)).cast("decimal(38,0)")).cast("decimal(20,0)")


def cache_identity(kind: Column, key: Column, digest: Column) -> Column:
    return F.concat_ws(":", kind, key, digest)


def dates_json(days: Column) -> Column:
    """Sorted distinct days as a JSON array."""
    return F.to_json(F.array_sort(F.array_distinct(days)))


def dates_of(text: Column) -> Column:
    """The days of a JSON array; anything but sorted distinct days raises."""
    days = F.from_json(text, "array<string>")
    good = days.isNotNull() & (F.to_json(days) == text) & (F.array_sort(F.array_distinct(days)) == days) & F.forall(days, is_day)
    return F.when(F.coalesce(good, F.lit(False)), days).otherwise(F.raise_error(F.lit("days are not canonical")).cast("array<string>"))


def exact_component(value: Column) -> Column:
    """A path component: each byte but letters, digits and -_.*'() as ! and two digits."""
    digits = F.hex(F.encode(value, "UTF-8"))
    count = F.octet_length(value)
    pairs = F.transform(F.filter(F.sequence(F.lit(0), count), lambda k: k < count), lambda k: F.substr(digits, 2 * k + 1, F.lit(2)))
    one = lambda p: F.decode(F.unhex(p), "ISO-8859-1")
    return F.array_join(F.transform(pairs, lambda p: F.when(one(p).rlike(r"^[A-Za-z0-9\-_.*'()]$"), one(p)).otherwise(F.concat(F.lit("!"), p))), "")


def disk_class(free: Column, high: int, critical: int, emergency: int) -> Column:
    """Unknown free space counts as none."""
    return F.when(free >= high, "normal").when(free >= critical, "high").when(free >= emergency, "critical").otherwise("emergency")


def error_number(name: Column) -> Column:
    known = F.create_map(*(F.lit(x) for k, n in enumerate(D.ERRORS, 1) for x in (n, k)))
    return F.coalesce(F.element_at(known, name), F.lit(D.UNKNOWN_ERROR))
