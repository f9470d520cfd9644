"""Header clean-up, aliases and code dictionaries. Headers are metadata; data stays in Spark."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Review sheet headers in the languages they arrive in. Fixed values.
REVIEW_ALIASES = {
    "ASIN": "variation",
    "asin": "variation",
    "评论时间": "date",
    "評論時間": "date",
    "评论人": "author",
    "評論人": "author",
    "VP评论": "verified",
    "VP評論": "verified",
    "赞同数": "helpful",
    "贊同數": "helpful",
    "标题": "title",
    "標題": "title",
    "内容": "body",
    "內容": "body",
    "星级": "rating",
    "星級": "rating",
    "图片地址": "images",
    "圖片地址": "images",
    "视频地址": "videos",
    "視頻地址": "videos",
    "评论链接": "url",
    "評論連結": "url",
    "型号": "style",
    "型號": "style",
}
REVIEW_COLUMNS = ["date", "author", "verified", "helpful", "title", "body", "rating", "images", "videos", "url", "variation", "style", "path"]

# Order table codes. Fixed values.
ORDER_CODES = {
    "ORD001": "order_id",
    "ORD002": "other_order_number",
    "ORD003": "order_date",
    "ORD004": "payment_date",
    "ORD005": "payment_total",
    "ORD006": "payment_method",
    "ORD007": "payment_currency",
    "ORD008": "seller_ebay_account",
    "ORD009": "seller_ebay_email",
    "ORD010": "recipient_name",
    "ORD011": "street_address_1",
    "ORD012": "street_address_2",
    "ORD013": "city_name",
    "ORD014": "state_or_province",
    "ORD015": "postal_code",
    "ORD016": "country_name",
    "ORD020": "buyer_ebay_id",
    "ORD021": "shipping_fee",
}
# Order detail codes. Fixed values.
DETAIL_CODES = {
    "ORE001": "order_id",
    "ORE002": "line_item_number",
    "ORE003": "ebay_item_code",
    "ORE004": "product_name",
    "ORE005": "erp_product_no",
    "ORE006": "application_data",
    "ORE007": "condition",
    "ORE008": "quantity",
    "ORE009": "unit_price",
    "ORE010": "listing_country",
    "ORE011": "email",
    "ORE012": "static_alias",
    "ORE013": "batch_key",
    "ORE014": "reserved_field",
}


def apply_aliases(df: DataFrame, aliases: dict[str, str], required: list[str]) -> DataFrame:
    """Rename the first alias of each canonical name, add missing columns as null, select in order."""
    taken = set(df.columns)
    renames = {}
    for old, new in aliases.items():
        if old in df.columns and new not in taken:
            renames[old] = new
            taken.add(new)
    # by position: two headers may differ in case only
    out = df.toDF(*[renames.get(c, c) for c in df.columns])
    return out.select(*[F.col(f"`{c}`") if c in out.columns else F.lit(None).cast("string").alias(c) for c in required])


def clean_names(df: DataFrame, strip_prefix: str | None = None) -> DataFrame:
    """Lower snake-case names; a clash keeps the item-level column and renames the order-level one."""
    plain, from_item = [], []
    for c in df.columns:
        item = bool(strip_prefix) and c.startswith(strip_prefix)
        plain.append(re.sub(r"[^\w]+", "_", c[len(strip_prefix) :] if item else c).lower())
        from_item.append(item)
    clash = {n for n, k in Counter(plain).items() if k > 1}
    named = [
        ("legacy_order_id" if n == "id" else f"order_{n}") if n in clash and not item else n for n, item in zip(plain, from_item)
    ]
    seen: Counter = Counter()
    final = []
    for n in named:
        final.append(f"{n}_dup_{seen[n]}" if seen[n] else n)
        seen[n] += 1
    return df.toDF(*final)


def rename_present(df: DataFrame, codes: dict[str, str], critical: list[str]) -> DataFrame:
    """Apply a code dictionary to the columns that exist; a missing critical column is an error."""
    out = df.withColumnsRenamed({old: new for old, new in codes.items() if old in df.columns})
    missing = [c for c in critical if c not in out.columns]
    if missing:
        raise ValueError(f"missing critical columns {missing}")
    return out


def align_by_modal_schema(frames: dict, max_renamed: int = 2, weights: dict | None = None) -> tuple[DataFrame, list]:
    """Union frames whose headers match the most common one; `weights` says for how many files a frame stands.

    A file with the same names in another order is reordered. One of equal width with at most
    `max_renamed` names that the common header lacks has corrupted labels and is renamed by position.
    Any other file is left out and listed.
    """
    seen: Counter = Counter()
    for name, df in frames.items():
        seen[tuple(df.columns)] += weights[name] if weights else 1
    canon = list(seen.most_common(1)[0][0])
    kept, dropped = [], []
    for name, df in frames.items():
        off = sum(a != b for a, b in zip(df.columns, canon))
        if sorted(df.columns) == sorted(canon):
            kept.append(df.select(*canon))
        elif len(df.columns) == len(canon) and off <= max_renamed:
            kept.append(df.toDF(*canon))
        else:
            dropped.append(name)
    out = kept[0]
    for df in kept[1:]:
        out = out.unionByName(df)
    return out, dropped


def resolve_header(wanted: str, headers: list[str]) -> str | None:
    """Exact header, else the only one containing the name, else the best by shared words."""
    if wanted in headers:
        return wanted
    inside = [h for h in headers if wanted in h or h in wanted]
    if len(inside) == 1:
        return inside[0]
    words = lambda s: set(re.split(r"[^\w]+|_", s.lower())) - {""}
    scored = sorted((-len(words(wanted) & words(h)), len(words(h) - words(wanted)), len(h), h) for h in headers if words(wanted) & words(h))
    return scored[0][3] if scored else None


# Headers that delimit and fill the blocks of a competitor sheet. Fixed values.
BLOCK_BRAND, BLOCK_SALES, BLOCK_REVIEW = "品牌", "銷售數據", "評論數據"


def blocks_to_long(df: DataFrame, lines: dict[str, str]) -> DataFrame:
    """Side-by-side column blocks (brand | item id | … | sales | review) as long rows.

    `lines` maps a line id to the header of its item-id column. Each brand column opens a block.
    """
    from martloom.operators.clean import ITEM_CODE, is_blank

    cols = df.columns
    brands = [i for i, c in enumerate(cols) if c.startswith(BLOCK_BRAND)]
    blocks = []
    for line, wanted in lines.items():
        header = resolve_header(wanted, [c for c in cols if not c.startswith((BLOCK_BRAND, BLOCK_SALES, BLOCK_REVIEW))])
        if header is None:
            continue
        at = cols.index(header)
        before = [i for i in brands if i < at]
        if not before:
            continue
        end = min([i for i in brands if i > at], default=len(cols))
        find = lambda mark: next((F.col(f"`{c}`").cast("string") for c in cols[at + 1 : end] if c.startswith(mark)), F.lit(None).cast("string"))
        blocks.append(
            F.struct(
                F.lit(line).alias("product_line_id"),
                F.trim(F.col(f"`{header}`").cast("string")).alias("item_id"),
                F.trim(F.col(f"`{cols[before[-1]]}`").cast("string")).alias("brand"),
                F.trim(find(BLOCK_SALES)).alias("sales_data"),
                F.trim(find(BLOCK_REVIEW)).alias("review_data"),
                F.lit(header).alias("source_header"),
            )
        )
    if not blocks:
        raise ValueError("no block header resolved")
    long = df.select(F.inline(F.array(*blocks)))
    return long.filter(F.col("item_id").rlike(ITEM_CODE)).withColumn("brand", F.when(is_blank("brand"), "UNKNOWN").otherwise(F.col("brand")))
