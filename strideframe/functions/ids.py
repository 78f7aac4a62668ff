"""Names, keys and content identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed prefixes, formats and media types.
ROOT = "synthetic-motion"
RUN_ID = r"^[A-Za-z0-9][A-Za-z0-9._-]*$"
FEED_NAME = r"^\d{8}T\d{12}Z-(.+)-([0-9a-f]{64})\.json$"
MEDIA_TYPES = {".json": "application/json", ".html": "text/html", ".js": "text/javascript",
               ".h5": "application/x-hdf5", ".bin": "application/octet-stream"}


def slug_id(member: Column) -> Column:
    """readable clip id with a digest tail."""
    bare = F.regexp_replace(F.regexp_replace(member, r"_poses\.npz$", ""), r"_stageii\.npz$", "")
    slug = F.regexp_replace(F.lower(bare), "[^a-z0-9]+", "-")
    slug = F.right(F.regexp_replace(slug, "^-+|-+$", ""), F.lit(72))
    return F.concat(slug, F.lit("-"), F.left(F.sha2(member, 256), F.lit(8)))


def canonical_json(**fields: Column) -> Column:
    """Compact JSON with sorted keys."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def content_id(length: int = 64, **fields: Column) -> Column:
    """leading hex digits of the digest of the canonical JSON."""
    return F.left(F.sha2(canonical_json(**fields), 256), F.lit(length))


def content_digests(text: Column) -> tuple[Column, Column]:
    """(SHA-256, MD5) of a text's bytes."""
    return F.sha2(text, 256), F.md5(text)


def exact_double(x: Column) -> Column:
    """A finite double as `mantissa*2^exponent` in whole numbers, without loss."""
    power = (52 - F.floor(F.log2(F.abs(x)))).cast("int")
    half = F.floor(power / 2).cast("int")                     # two factors, so that small numbers do not overflow the power
    mantissa = x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)
    return F.when(x == 0, "0").otherwise(F.concat(mantissa.cast("bigint").cast("string"), F.lit("*2^"), (-power).cast("string")))


def participant_key(gender: Column, shape: Column) -> Column:
    """prefix, gender and 12 hex digits of the shape vector; shapes that differ in any bit differ in the text."""
    text = F.array_join(F.transform(shape, lambda x: exact_double(x.cast("double"))), ",")
    return F.concat(F.lit("smplh-"), gender, F.lit("-"), F.left(F.sha2(text, 256), F.lit(12)))


def publication_prefix(target: Column, run_id: Column) -> Column:
    """prefix of a target; null for a combination that is not allowed."""
    return (F.when((target == "prod") & run_id.isNull(), F.lit(f"{ROOT}/prod/v1"))
            .when((target == "dev") & run_id.rlike(RUN_ID), F.concat(F.lit(f"{ROOT}/dev/"), run_id, F.lit("/v1"))))


def feed_key(prefix: Column, posted: Column, candidate: Column, version: Column) -> Column:
    """day and hour folder, microsecond stamp, candidate and version."""
    stamp = F.date_format(posted, "yyyyMMdd'T'HHmmssSSSSSS'Z'")
    folder = F.date_format(posted, "yyyyMMddHH")
    return F.concat(prefix, F.lit("/index-feed/"), folder, F.lit("/"), stamp, F.lit("-"), candidate, F.lit("-"), version, F.lit(".json"))


def feed_pair(key: Column) -> tuple[Column, Column]:
    """(candidate, version) of a feed key; null unless the whole name matches."""
    name = F.element_at(F.split(key, "/"), -1)
    ok = name.rlike(FEED_NAME)
    return (F.when(ok, F.regexp_extract(name, FEED_NAME, 1)), F.when(ok, F.regexp_extract(name, FEED_NAME, 2)))


def packed_name(ordinal: Column, name: Column | None = None) -> Column:
    """zero-padded record or shard name."""
    digits = F.format_string("%04d", ordinal)
    return F.concat(F.lit("shard-"), digits) if name is None else F.concat(F.lit("clip"), digits, F.lit("-"), name)


def key_digest(key: Column, prefix: Column) -> Column:
    """digest in an object key, null when the key escapes its namespace."""
    digest = F.regexp_extract(key, r"/([0-9a-f]{64})(?:\.[a-z0-9.]+|/[^/]+)?$", 1)
    return F.when(key.startswith(F.concat(prefix, F.lit("/"))) & (F.length(digest) == 64), digest)


def media_type(path: Column) -> Column:
    """Media type by extension, octet-stream for the rest."""
    ext = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    out = F.lit("application/octet-stream")
    for k, v in MEDIA_TYPES.items():
        out = F.when(ext == k, v).otherwise(out)
    return out
