"""Periods and rule tables. Operators take these as arguments."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Periods:
    """All period settings of one run."""

    previous_year: str = "2019"
    current_year: str = "2020"
    panel_quarters: tuple[str, ...] = ("2019Q1", "2019Q2", "2020Q1", "2020Q2")
    projected_quarters: tuple[str, ...] = ("2020Q1", "2020Q2")
    base_quarter: str = "2019Q2"
    report_quarter: str = "2020Q2"
    external_start: str = "201701"

    @property
    def years(self) -> tuple[str, str]:
        return self.previous_year, self.current_year


# --- Fixed values --------------------------------------------------------------
# Constants of the estimation method. They must be exactly these for results to
# agree, and are given in their natural order.

ID_WIDTH = 7
NOT_AVAILABLE = "#N/A"
PROVINCE_SUFFIX = "省|市"
CITY_SUFFIX = "市"
MUNICIPAL_LABEL = "市辖区"
MUNICIPAL_CITY = "北京"
FEED_PROVINCE = "广东"
FEED_CITY = "广州"
EXTRA_SIZE_PROVINCE = "山东"

PACK_PREFIX_RECODES = {"47775": "58906", "06470": "64895"}
SITE_RECODES = {"PCHC09264": "PCHC04241"}

IMPUTED_CITIES = [
    "北京", "常州", "福州", "广州", "杭州", "南京", "宁波", "泉州", "厦门",
    "上海", "苏州", "温州", "无锡", "济南", "徐州", "合肥", "绍兴", "青岛",
]
SPLIT_SEGMENT_CITIES = ["上海"]
EQUAL_SHARE_CITY = "福州"
TRANSFER_TARGET = "上海"
TRANSFER_DONOR = "北京"
STRICT_FLAG_CITIES = ["北京", "上海"]

REASSIGNED_CLASSES = ["C07", "C08"]
REASSIGNED_MARKET = "IHD"
EXCLUDED_MOLECULES = [("IHD", "IVABRADINE"), ("OAD", "EPALRESTAT")]
EXCLUDED_PRODUCTS = [("IHD", "CORLENTOR"), ("OAD", "TANG LIN")]

# class, market, share
ALLOCATION = [
    ("C07", "IHD", 0.25),
    ("C07", "HTN", 0.75),
    ("C08", "IHD", 0.10),
    ("C08", "HTN", 0.90),
]

SCALED_MARKETS = ["HTN", "IHD", "OAD"]
# city, market or any, factor
SCALE_OVERRIDES = [
    ("苏州", None, 0.5),
    ("宁波", None, 0.6),
    ("温州", None, 2.0),
    ("厦门", None, 1.8),
    ("福州", None, 10.0),
    ("青岛", None, 3.0),
    ("济南", None, 2.0),
    ("泉州", None, 1.5),
    ("绍兴", "OAD", 0.3),
    ("徐州", "OAD", 0.3),
]

GROWTH_CEILING = 1.5
NEIGHBOURS = 3
EXTERNAL_GEOGRAPHY = "CHT"
PRICE_OVERRIDES = {"4268604": 103.26608, "4268602": 52.12415}

SECOND_CHANNEL_PATTERN = "服务站"
SECOND_CHANNEL_PROVINCE = "北京市"
ORAL_FORMS = ["CAP ", "TAB ", "PILL"]
DELIVERED_FORMS = ["CAP", "TAB", "PIL"]
FORM_CHECKED_MARKETS = ["HTN", "IHD"]
DROPPED_CLASSES = ["C05", "C07", "C08"]
SUPPLEMENT_CLASS = "A10S"
CORP_BY_PRODUCT = {"GLUCOPHAGE": "MERCK GROUP", "ONGLYZA": "ASTRAZENECA GROUP"}
CORP_RENAMES = {"LUYE GROUP": "LVYE GROUP"}

POLICY_CATEGORY = "4+7城市"
BID_MOLECULE_LABEL = "4+7分子"
BID_MOLECULES = ["赖诺普利", "卡托普利"]
MERGED_BID_LABELS = ["中标品规", "非中标品规"]
MERGED_BID_LABEL = "仿制"
BID_SUFFIX = "-2|-1"
BLANK_BID_LABEL = "非中标产品"
ORIGIN_LABELS = {"MNC": "原研", "Local": "仿制"}
MAKER_BUCKETS = {"Imported": "MNC", "Joint Venture": "MNC"}
DEFAULT_MAKER = "Local"
DROPPED_FORM_PATTERN = "AMP"
DROPPED_MOLECULE = "ENALAPRIL+FOLIC ACID"

# market, class, molecule or any, label
CLASS_RULES = [
    ("HTN", "C09A", None, "RAASi Plain"),
    ("HTN", "C09C", None, "RAASi Plain"),
    ("HTN", "C09B", None, "RAASi FDC"),
    ("HTN", "C09D", None, "RAASi FDC"),
    ("HTN", "C02A", None, "ANTI-HTN"),
    ("HTN", "C02B", None, "ANTI-HTN"),
    ("HTN", "C02C", None, "ANTI-HTN"),
    ("HTN", "C03A", None, "DIURETICS"),
    ("HTN", "C07A", None, "BB"),
    ("HTN", "C08A", None, "CCB"),
    ("HTN", "C08B", None, "CCB"),
    ("OAD", "A10H", None, "SULPHONYLUREA"),
    ("OAD", "A10J", None, "BIGUANIDE"),
    ("OAD", "A10K", None, "GLITAZONE"),
    ("OAD", "A10L", None, "AG Is"),
    ("OAD", "A10M", None, "METAGLINIDE"),
    ("OAD", "A10N", None, "DPP-IV"),
    ("OAD", "A10P", None, "SGLT2"),
    ("OAD", "A10S", None, "GLP-1"),
    ("OAD", "A10X", None, "OTHERS"),
    ("IHD", "C07A", None, "BB"),
    ("IHD", "C08A", None, "CCB"),
    ("IHD", "C01E", None, "NITRITES"),
    ("IHD", "C01D", "TRIMETAZIDINE", "TMZ"),
    ("IHD", "C01D", None, "OTHERS"),
]

OVERRIDE_CHANNEL = "CHC"
OVERRIDE_CITIES = ["福州", "泉州", "厦门", "济南", "青岛"]
OVERRIDE_LABEL = "DPP-IV"
# pack, quarter, factor
OVERRIDE_FACTORS = [
    ("5890602", "2019Q1", 1.207828),
    ("5890602", "2019Q2", 1.174208),
    ("4268602", "2019Q1", 1.361853),
    ("4268602", "2019Q2", 1.37669),
    ("4268604", "2019Q1", 1.245801),
    ("4268604", "2019Q2", 1.25994),
    ("5739702", "2019Q1", 1.600415),
    ("5739702", "2019Q2", 1.388511),
    ("5518904", "2019Q1", 1.283041),
    ("5518904", "2019Q2", 1.580584),
]

# Rounding of delivered measures (digits, half to even).
DELIVERY_ROUNDING = {"sales": 2, "units": 0, "dosage_units": 0}
