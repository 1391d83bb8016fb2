"""Licence scan: whole texts, and whole lines, looked up among digests of known licences.

A text and every known licence pass through the same normal form; equal normal forms have equal
SHA-256 digests, and the lookup is a hash join on the digest.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.common import fresh, stored

# Spellings that count as one (written, taken for).
SPELLINGS = [
    ("licence", "license"),
    ("licensor s", "licensors"),
    ("organisation", "organization"),
    ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"),
    ("noninfringement", "non infringement"),
    ("sublicence", "sublicense"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("authorisation", "authorization"),
    ("merchantibility", "merchantability"),
    ("per cent", "percent"),
]

#: Complete licence texts, one file each, named by their SPDX ids; a title comes first.
TEXTS = Path(__file__).parent / "licence_texts"

# Further titles under which short licences are found.
TITLES = {
    "MIT": ["The MIT License (MIT)", "The MIT License", "Expat License", "MIT/X11 License"],
    "MIT-0": ["MIT No Attribution License", "MIT-0 License"],
    "ISC": ["The ISC License", "Internet Systems Consortium license"],
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause License (0BSD)", "Zero Clause BSD License"],
    "BSD-2-Clause": ["The 2-Clause BSD License", "The BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["The 3-Clause BSD License", "The BSD 3-Clause License", "BSD License",
                     "New BSD License", "Modified BSD License", "The BSD License"],
    "Unlicense": ["UNLICENSE", "Unlicense License"],
    "Zlib": ["The zlib License", "zlib/libpng License"],
    "BSL-1.0": ["Boost Software License", "The Boost Software License, Version 1.0"],
}

# Notices that stand for a licence (id, text).
NOTICES = [
    ("MIT-notice", "Released under the MIT License."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    (
        "GPL-3.0-notice",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
]

#: After it some licences tell how to apply them.
END_OF_TERMS = "END OF TERMS AND CONDITIONS"

#: A line that is a copyright notice: behind the word or the sign comes a sign, a year or a place
#: for one. Lines of the licence that begin with the word by chance are none of those.
NOTICE_LINE = (
    r"^[ \t]*(?:(?:copyright[ \t:]*)?(?:\(c\)|©)|copyright[ \t:]+(?:[0-9]{4}|<|\[|\{|yyyy))[^\n]*$"
    r"|^[ \t]*all rights reserved[ \t.]*$"
)


def known_texts() -> list[tuple[str, str, str, str]]:
    """(id, title, terms, appendix) of all known licences and notices; a licence with several
    titles stands there several times."""
    out = []
    for path in sorted(TEXTS.glob("*.txt")):
        title, _, rest = path.read_text(encoding="utf-8").strip().partition("\n\n")
        terms, end, appendix = rest.partition(END_OF_TERMS)
        for name in [title, *TITLES.get(path.stem, [])]:
            out.append((path.stem, name, terms + end, appendix))
    return [*out, *[(name, "", text, "") for name, text in NOTICES]]


def normal_lines(text: str | Column) -> Column:
    """The text lower-cased, line by line, with copyright lines emptied, all that is no letter
    or digit turned into single spaces, and equivalent spellings made one. Null stays null."""
    text = F.col(text) if isinstance(text, str) else text
    lines = F.regexp_replace(F.lower(text), f"(?m){NOTICE_LINE}", "")
    plain = F.regexp_replace(lines, r"[^\p{L}\p{N}\n]+", " ")
    for written, taken in SPELLINGS:
        plain = F.replace(plain, F.lit(written), F.lit(taken))
    return plain


def normal_text(lines: Column) -> Column:
    """Normal lines joined into one line, with single spaces."""
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def known_digests(spark: SparkSession) -> DataFrame:
    """(license_id, license_digest, license_chars), one row per different normal form of a known
    text: with its title or one of its others or none, with its appendix or without."""
    rows = [
        F.struct(*[F.lit(v).alias(n) for n, v in zip(("i", "title", "terms", "appendix"), row)])
        for row in known_texts()
    ]
    texts = spark.range(1).select(F.inline(F.array(*rows)))
    whole = F.concat_ws("\n", "title", "terms", "appendix")
    variants = F.array(
        whole,
        F.concat_ws("\n", "terms", "appendix"),
        F.concat_ws("\n", "title", "terms"),
        F.col("terms"),
    )
    every = texts.select(F.col("i").alias("license_id"), F.explode(variants).alias("text"))
    return stored(digests_of(every, "license_id", "text"), "known-licenses")


def digests_of(texts: DataFrame, key: str, text: str) -> DataFrame:
    """The known table of any licence texts; equal normal forms keep their smallest id."""
    normal = texts.select(F.col(key).alias("license_id"), normal_text(normal_lines(text)).alias("n"))
    return (
        normal.where(F.length("n") > 0)
        .groupBy(F.sha2("n", 256).alias("license_digest"))
        .agg(F.min("license_id").alias("license_id"), F.min(F.length("n")).alias("license_chars"))
    )


def scan(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``text_digest``, ``license_id``, ``n_license_lines``,
    ``line_license_ids``.

    ``license_id`` names the known licence that the whole text is, else null; ``text_digest`` is
    the digest of the normal form (null for null text, that of the empty text for texts without
    letter or digit). ``n_license_lines`` counts lines that are a known licence or notice by
    themselves, ``line_license_ids`` lists their ids, sorted and comma-joined (empty: none).
    Only lines as long as some known text are digested, which loses none. Repeated rows are told
    apart by their place; other columns are ignored.

    ``known`` comes from ``digests_of``; the joins carry no hint, so its size decides how they
    are run. The lengths that occur in it are the only thing taken to the driver: at most one
    number for each length of a known text.
    """
    lengths = [r[0] for r in known.select("license_chars").distinct().collect()]
    wanted = F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>")
    lines = fresh("lf_lines", docs.columns)
    uid = fresh("lf_uid", docs.columns)
    short = F.filter(
        F.transform(F.split(lines, "\n"), lambda line: F.trim(line)),
        lambda line: F.array_contains(wanted, F.length(line)),
    )
    slim = stored(
        docs.select(F.col(key).alias("doc_id"), normal_lines(text).alias(lines)).select(
            F.monotonically_increasing_id().alias(uid),
            "doc_id",
            F.sha2(normal_text(F.col(lines)), 256).alias("text_digest"),
            F.transform(short, lambda line: F.sha2(line, 256)).alias("line_digests"),
        ),
        "license-digests",
    )
    ids = known.select("license_digest", "license_id")
    whole = slim.drop("line_digests").join(
        ids, F.col("text_digest") == F.col("license_digest"), "left"
    )
    found = (
        slim.select(uid, F.explode("line_digests").alias("license_digest"))
        .join(ids, "license_digest")
        .groupBy(uid)
        .agg(
            F.count("*").alias("n"),
            F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("ids"),
        )
    )
    return whole.join(found, uid, "left").select(
        "doc_id",
        "text_digest",
        "license_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_license_lines"),
        F.coalesce("ids", F.lit("")).alias("line_license_ids"),
    )
