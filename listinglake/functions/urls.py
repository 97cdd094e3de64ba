"""Links and labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listinglake import fixed_values as fv
from listinglake.functions.nulls import present


def from_id(base: str, id_: Column, tail: str = "") -> Column:
    return F.concat(F.lit(base + "/"), id_.cast("string"), F.lit(tail))


def from_slug(base: str, slug: Column, id_: Column) -> Column:
    """``base/properties/slug/id``; '' when there is no slug."""
    return F.when(
        present(slug).isNotNull(),
        F.concat(F.lit(base + "/properties/"), slug, F.lit("/"), id_),
    ).otherwise("")


def absolute_path(c: Column, base: str) -> Column:
    """Prefix the site when the text is a path."""
    return F.when(c.startswith("/"), F.concat(F.lit(base), c)).otherwise(c)


def absolute_unless_http(c: Column, base: str) -> Column:
    """Prefix the site to any non-empty text that is not a full URL."""
    return F.when(present(c).isNull() | c.startswith("http"), c).otherwise(
        F.concat(F.lit(base), c)
    )


def home_photo(source_id: Column, mls_id: Column, photo_format: Column) -> Column:
    """CDN photo link; the folder is the last three characters of the id."""
    complete = (
        present(mls_id).isNotNull()
        & present(source_id).isNotNull()
        & present(photo_format).isNotNull()
    )
    return F.when(
        complete,
        F.concat(
            F.lit(fv.REDFIN_PHOTO_BASE + "/"), source_id, F.lit("/bigphoto/"),
            F.right(mls_id, F.lit(3)), F.lit("/"), mls_id, F.lit("_0."), photo_format,
        ),
    )


def image_from_token(token: Column) -> Column:
    return F.when(
        present(token).isNotNull(), F.concat(F.lit(fv.TWIDDY_IMAGES + "/"), token)
    )
