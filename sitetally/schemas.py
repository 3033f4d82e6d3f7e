"""Table layouts."""

from __future__ import annotations

from pyspark.sql import types as T

_s, _l, _i, _d, _b = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


SEED = _struct(city=_s)
PRACTICE = _struct(id=_l, name=_s, website=_s, phone=_s, address=_s, source=_s)
CAPTURE = _struct(site=_s, seq=_l, status=_i, final_url=_s, content_type=_s, html=_s)
PATTERN = _struct(prio=_i, category=_s, strength=_s, vendor=_s, regex=_s)

FEED_A_PAGE = _struct(
    city=_s,
    businesses=T.ArrayType(_struct(
        id=_s, name=_s, display_phone=_s, location=_struct(address1=_s, city=_s, state=_s))))
FEED_A_DETAIL = _struct(id=_s, url=_s, website=_s)
FEED_B_PAGE = _struct(
    city=_s,
    results=T.ArrayType(_struct(place_id=_s, name=_s, formatted_address=_s)),
    next_page_token=_s)
FEED_B_DETAIL = _struct(place_id=_s, result=_struct(website=_s, formatted_phone_number=_s))
SEARCH_A = _struct(id=_l, offset=_l, webPages=_struct(value=T.ArrayType(_struct(name=_s, url=_s, snippet=_s))))
SEARCH_B = _struct(id=_l, offset=_l, organic_results=T.ArrayType(_struct(title=_s, link=_s, snippet=_s)))

# Fixed values. Detection rows as written to flat files: 22 columns, multi-valued cells joined by ";".
DETECTION_CSV = _struct(
    id=_l, name=_s, website=_s, final_url=_s, http_status=_i,
    has_online_booking=_b, has_online_forms=_b, has_online_payments=_b,
    third_party_booking_clues=_s, third_party_forms_clues=_s,
    third_party_payments_clues=_s, third_party_other_clues=_s,
    likely_booking_vendor=_s,
    phone_clues_site=_s, likely_phone_provider=_s,
    pms_clues_site=_s, likely_pms=_s, pms_confidence=_d,
    evidence_urls=_s,
    booking_urls=_s, payment_urls=_s, forms_urls=_s)

# Columns of the host report file.
HOST_REPORT = (
    "host", "pages_attempted", "pages_fetched", "http_2xx", "http_403", "http_429", "http_5xx", "captcha_hits", "backoff_events",
    "disallowed_paths", "consec_errors_final", "backoff_seconds_final", "pages_count", "robots_crawl_delay", "robots_cached",
    "sample_evidence_urls")

LIST_COLUMNS = (
    "third_party_booking_clues", "third_party_forms_clues", "third_party_payments_clues", "third_party_other_clues",
    "phone_clues_site", "pms_clues_site", "evidence_urls", "booking_urls", "payment_urls", "forms_urls")
