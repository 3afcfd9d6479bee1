"""Columns of the raw tables (all text) and types of the derived ones.

Fixed values: column names, which are those of the files.
"""

from __future__ import annotations

STAGED = ("article_id", "title", "source", "raw_url", "clean_url", "published_date", "rss_description", "article_text", "summary_ai", "staged_at", "extraction_status", "summarize_status", "classify_status", "Processed")
NEWS_FEED = ("ID", "Title", "CleanURL", "Source", "PublishedDate", "Summary_AI", "Primary_Category", "Secondary_Categories", "States", "DC_ID", "Is_Duplicate", "Duplicate_Of", "Strategy_Alignment_Score", "Relevance_Score", "Mentions_Specific_DC", "Article_Text")
#: Raw column of a facility file: (column of the table, how it is read).
FACILITY = {
    "Asset_ID": ("asset_id", "text"), "Canonical_Name": ("name", "text"), "Operator": ("operator", "text"), "Company Type": ("company_type", "type"), "Status": ("status", "status"),
    "estimated_mw": ("estimated_mw", "number"), "Total Space (sqft)": ("total_sqft", "number"), "Colocation Space (sqft)": ("colo_sqft", "number"), "Power Capacity (MW)": ("power_cap_mw", "number"),
    "street_address": ("address", "text"), "city": ("city", "text"), "state": ("state", "text"), "postal_code": ("postal_code", "text"), "latitude": ("lat", "number"), "longitude": ("lon", "number"),
}
#: Raw column of a generator sheet: column of the table.
GENERATOR = {
    "Plant ID": "plant_id", "Plant Name": "plant_name", "Plant State": "state", "County": "county", "Nameplate Capacity (MW)": "mw", "Technology": "technology", "Status": "status", "Latitude": "lat", "Longitude": "lon",
}
SOIL = {"h3_r6": "cell", "soil_rock_class": "rock", "soil_rock_frag_pct": "fragments", "soil_slope_pct": "slope", "soil_depth_to_bedrock_cm": "depth"}
REVIEW = ("article_id", "article_title", "published_date", "source", "dc_id", "canonical_name", "operator", "dc_state", "confidence", "match_method", "matched_text", "review_status")
STAGED_DDL = ", ".join(f"{c} string" for c in STAGED)
NEWS_FEED_DDL = ", ".join(f"{c} string" for c in NEWS_FEED)


def require(columns: list[str], needed: tuple[str, ...] | list[str], table: str) -> None:
    """Raise if a table lacks columns that its transform reads."""
    missing = [c for c in needed if c not in columns]
    if missing:
        raise ValueError(f"{table} lacks {', '.join(missing)}")
