"""Image size arithmetic; all factors are doubles and sides are cut, not rounded."""

from pyspark.sql import functions as F

# Media types that are fetched, and the two size limits in bytes.
SUPPORTED_TYPES = ("image/jpeg", "image/png", "image/gif", "image/webp")
FETCH_SIZE_LIMIT = 3_750_000
DESCRIBE_SIZE_LIMIT = 3_932_160
MAX_SIDE = 8000


def base64_text(content):
    """Base64 in one line; the built-in function may break it every 76 characters."""
    return F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))


def base64_length(size):
    """Exact length of the base64 text of ``size`` bytes."""
    return (F.lit(4) * F.ceil(size / F.lit(3))).cast("bigint")


def base64_estimate(size):
    """Size after base64 in the unit of ``size``, which may be fractional."""
    return F.ceil((size.cast("double") / F.lit(3.0)) * F.lit(4.0)).cast("bigint")


def is_supported(mime):
    """Media type is in the allow-list; an unknown type is not."""
    return F.coalesce(mime.isin(*SUPPORTED_TYPES), F.lit(False))


def _cut(side, factor):
    return (side * factor).cast("int")


def fit(width, height, size, max_width=None, max_height=None, max_size=None):
    """Target sides so that size and sides come within their limits.

    Only a limit that is exceeded shrinks the image, and the strictest one
    counts. Returns struct<width, height, resize>.
    """

    def over(value, limit):
        if not limit:
            return []
        return [F.when(value > limit, F.lit(float(limit)) / value.cast("double"))]

    factors = [F.lit(1.0)] + over(size, max_size) + over(width, max_width) + over(height, max_height)
    factor = F.least(*factors) if len(factors) > 1 else factors[0]
    new_width, new_height = _cut(width, factor), _cut(height, factor)
    return F.struct(
        new_width.alias("width"),
        new_height.alias("height"),
        ((new_width != width) | (new_height != height)).alias("resize"),
    )


def refit(width, height, new_size, max_size):
    """Second reduction when the resized image is still too large.

    ``width`` and ``height`` are the already reduced sides. Returns
    struct<width, height, resize>.
    """
    # Fixed value: the margin kept below the limit.
    factor = F.lit(float(max_size)) / new_size.cast("double") - F.lit(0.05)
    over = F.coalesce(new_size > max_size, F.lit(False))
    return F.struct(
        F.when(over, _cut(width, factor)).otherwise(width).alias("width"),
        F.when(over, _cut(height, factor)).otherwise(height).alias("height"),
        over.alias("resize"),
    )
