"""Path expressions. All of them are plain Column functions that stay in generated code,
except the ``..`` folding, which needs an array fold."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted image suffixes, the folder of unlabelled images, the unlabelled
# label and its id, and the prefix of an already normalised dataset folder.
IMAGE_SUFFIXES = ("png", "jpg", "jpeg", "bmp")
TEST_FOLDER = "test_data"
TEST_LABEL = "test"
TEST_LABEL_ID = -1
NORMALIZED_PREFIX = "normalized_"
NORMALIZED_ROOT = "datasets/normalized"

# Scheme and authority of a file address.
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?"

# Ordinals of the three listing branches, in manifest order.
FROM_LABEL, FROM_ROOT, FROM_TEST_FOLDER = 0, 1, 2


def is_image(path: Column) -> Column:
    return F.lower(path).rlike(rf"\.({'|'.join(IMAGE_SUFFIXES)})$")


def base_name(path: Column) -> Column:
    """Text after the last slash; empty for a path that ends with one."""
    return F.substring_index(path, "/", -1)


def strip_scheme(path: Column) -> Column:
    """``file:/a``, ``hdfs://host:1/a`` and ``/a`` all become ``/a``."""
    return F.regexp_replace(path, SCHEME + "(?=/)", "")


def normalise_path(path: Column) -> Column:
    """Lexical clean-up: repeated slashes, ``.`` and ``..`` segments, trailing slash."""
    absolute = path.startswith("/")
    # Exactly two leading slashes are kept, as POSIX allows them a meaning of their own.
    prefix = (
        F.when(path.rlike(r"^//(?!/)"), "//").when(absolute, "/").otherwise("")
    )
    segments = F.filter(F.split(path, "/"), lambda s: ~s.isin("", "."))

    def fold(done: Column, segment: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        nothing_to_pop = (F.size(done) == 0) | (last == "..")
        return (
            F.when(segment != "..", F.array_append(done, segment))
            .when(~nothing_to_pop, F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
            .when(absolute, done)
            .otherwise(F.array_append(done, segment))
        )

    empty = F.array().cast("array<string>")
    joined = F.concat(prefix, F.array_join(F.aggregate(segments, empty, fold), "/"))
    return F.when(joined == "", ".").otherwise(joined)


def absolute_path(path: Column, working_folder: str) -> Column:
    return normalise_path(
        F.when(path.startswith("/"), path).otherwise(F.concat_ws("/", F.lit(working_folder), path))
    )


def relative_to(path: Column, root: str) -> Column:
    """Part of ``path`` below ``root``; null for anything outside. Schemes may differ."""
    base = re.sub(SCHEME, "", root.rstrip("/")) + "/"
    start = F.instr(path, base)
    # The pattern sees only what stands before the root, usually nothing or a scheme.
    below = (start == 1) | ((start > 1) & F.left(path, start).rlike(SCHEME + "/$"))
    return F.when(below, F.substring(path, start + len(base), F.length(path)))


def _below(root: str, rest: str) -> str:
    """Pattern of paths whose part below ``root`` matches ``rest``."""
    base = re.sub(SCHEME, "", root.rstrip("/")).replace("\\E", "\\E\\\\E\\Q")
    return rf"^(?:{SCHEME[1:]})?\Q{base}\E/{rest}$"


def is_listed(path: Column, root: str) -> Column:
    """Files of the root and of its direct sub-folders; anything deeper does not count."""
    return path.rlike(_below(root, r"(?:[^/]+/)?[^/]+"))


def is_counted(path: Column, root: str) -> Column:
    """Listed files that take a number: images, and every file of the test folder."""
    suffixes = "|".join(IMAGE_SUFFIXES)
    return path.rlike(_below(root, rf"(?:{TEST_FOLDER}/[^/]+|(?:[^/]+/)?[^/]*\.(?i:{suffixes}))"))


def folder_of(path: Column, root: str) -> Column:
    """Sub-folder of a listed file; empty for a file of the root."""
    return F.regexp_extract(path, _below(root, r"(?:([^/]+)/)?[^/]+"), 1)


def source_of(folder: Column) -> Column:
    return (
        F.when(folder == "", FROM_ROOT).when(folder == TEST_FOLDER, FROM_TEST_FOLDER).otherwise(FROM_LABEL)
    )


def normalized_name(source: Column, folder: Column, index: Column, overflow: Column) -> Column:
    """File name in the normalised dataset; the index is padded to four digits."""
    index = index.cast("long")
    return (
        F.when(source == FROM_ROOT, F.format_string("test_root_%04d.png", index))
        .when(source == FROM_TEST_FOLDER, F.format_string("test_orig_%04d.png", index))
        .when(overflow, F.format_string("test_%s_%04d.png", folder, index))
        .otherwise(F.format_string("%s_%04d.png", folder, index))
    )


def output_folder(input_path: Column, explicit: Column, project_root: str) -> Column:
    """Explicit folder first, then the input itself when already normalised, else the
    default place below the project."""
    name = base_name(input_path)
    return F.coalesce(
        explicit,
        F.when(name.startswith(NORMALIZED_PREFIX), input_path),
        F.concat_ws("/", F.lit(project_root), F.lit(NORMALIZED_ROOT), name),
    )
