"""Input tables: file headings, canonical names and types.

Each entry maps the heading in the delivered file to the canonical column and
its type. Types are declared, never inferred.
"""

from __future__ import annotations

Columns = dict[str, tuple[str, str]]

# --- Fixed values: headings of the delivered files ------------------------------

PROVINCIAL_FEED: Columns = {
    "Year": ("year", "string"),
    "Month": ("date", "string"),
    "Quarter": ("quarter", "string"),
    "Province": ("province", "string"),
    "City": ("city", "string"),
    "County": ("district", "string"),
    "Hospital_Name": ("hospital", "string"),
    "ATC4_Code": ("atc4", "string"),
    "NFC123_Code": ("nfc", "string"),
    "Prd_desc": ("product", "string"),
    "packcode": ("packid", "string"),
    "Price": ("price", "double"),
    "Value": ("sales", "double"),
}
CITY_HISTORY: Columns = {
    "Year": ("year", "string"),
    "PERIOD": ("date", "string"),
    "QUARTER": ("quarter", "string"),
    "province": ("province", "string"),
    "city": ("city", "string"),
    "district": ("district", "string"),
    "PCHC": ("site", "string"),
    "hosp_name": ("hospital", "string"),
    "PFC": ("packid", "string"),
    "UNIT": ("units", "double"),
    "VALUE": ("sales", "double"),
}
TOTAL_HISTORY: Columns = {
    "year": ("year", "string"),
    "date": ("date", "string"),
    "quarter": ("quarter", "string"),
    "province": ("province", "string"),
    "city": ("city", "string"),
    "pchc": ("site", "string"),
    "market": ("market", "string"),
    "atc3": ("atc3", "string"),
    "molecule_desc": ("molecule", "string"),
    "packid": ("packid", "string"),
    "units": ("units", "double"),
    "sales": ("sales", "double"),
}
CITY_FEED: Columns = {
    "period": ("period", "string"),
    "name": ("hospital", "string"),
    "pfc": ("packid", "string"),
    "unit": ("units", "double"),
    "value": ("sales", "double"),
}
EXTERNAL_SALES: Columns = {
    "Period_Code": ("period", "string"),
    "Pack_ID": ("packid", "string"),
    "Geography_id": ("geography", "string"),
    "LC": ("sales", "double"),
}
DELIVERED_HISTORY: Columns = {
    "Pack_ID": ("packid", "string"),
    "Channel": ("channel", "string"),
    "Province": ("province", "string"),
    "City": ("city", "string"),
    "Date": ("quarter", "string"),
    "ATC3": ("atc3", "string"),
    "MKT": ("market", "string"),
    "Molecule_Desc": ("molecule", "string"),
    "Prod_Desc": ("product", "string"),
    "Pck_Desc": ("pack_desc", "string"),
    "Corp_Desc": ("corp_desc", "string"),
    "Sales": ("sales", "double"),
    "Units": ("units", "double"),
    "DosageUnits": ("dosage_units", "double"),
    "Period-MAT": ("period_mat", "string"),
    "CITY-EN": ("city_en", "string"),
    "TherapeuticClsII": ("class_label", "string"),
    "Prod_CN_Name": ("product_cn", "string"),
    "Package": ("package", "string"),
    "Dosage": ("dosage", "string"),
    "Quantity": ("quantity", "int"),
    "是否是4+7城市": ("policy", "string"),
    "是否进入带量采购": ("name1", "string"),
    "是否是原研": ("name3", "string"),
    "是否是中标品种": ("name2", "string"),
    "是否是MNC": ("maker_type", "string"),
    "ATC3中文分类": ("class_name", "string"),
}
SITE_UNIVERSE: Columns = {
    "省": ("province", "string"),
    "地级市": ("city", "string"),
    "区[县/县级市】": ("district", "string"),
    "单位名称": ("hospital", "string"),
    "PCHC_Code": ("site", "string"),
    "其中：西药药品收入（千元）": ("est", "double"),
}
PACK_REFERENCE: Columns = {
    "Pack_Id": ("packid", "string"),
    "ATC4_Code": ("atc4", "string"),
    "Molecule_Desc": ("molecule", "string"),
    "商品名": ("product", "string"),
}
MARKET_DEFINITION: Columns = {
    "Molecule_Desc": ("molecule", "string"),
    "TA": ("market", "string"),
}
SEGMENTS: Columns = {
    "city": ("city", "string"),
    "district": ("district", "string"),
    "seg_up": ("seg", "int"),
}
HISTORIC_SITES: Columns = {"mapping": ("site", "string")}
SITE_SIZES: Columns = {
    "省": ("province", "string"),
    "地级市": ("city", "string"),
    "PCHC_Code": ("site", "string"),
    "Est_DrugIncome_RMB": ("est", "double"),
}
FLAGGED_PAIRS: Columns = {"mapping": ("site", "string"), "mkt": ("market", "string")}
FACTORS: Columns = {
    "mkt": ("market", "string"),
    "seg": ("seg", "int"),
    "factor": ("factor", "double"),
}
PACK_DETAILS: Columns = {
    "Pack_Id": ("packid", "string"),
    "Pck_Desc": ("pack_desc", "string"),
    "Corp_Desc": ("corp_desc", "string"),
    "PckSize_Desc": ("pack_size", "double"),
}
SITE_FLAGS: Columns = {
    "省": ("province", "string"),
    "地级市": ("city", "string"),
    "PCHC_Code": ("site", "string"),
    "是否是13城市": ("in_scope", "string"),
    "zs_flag": ("zs_flag", "int"),
}
CORPORATIONS: Columns = {
    "Corp_ID": ("corp_id", "string"),
    "Corp_Desc": ("corp_desc", "string"),
}
PRODUCTS: Columns = {
    "Pack_Id": ("packid", "string"),
    "Pck_Desc": ("pack_desc", "string"),
    "Corp_ID": ("corp_id", "string"),
    "PckSize_Desc": ("pack_size", "double"),
}
POLICY_CITIES: Columns = {"类别": ("policy", "string"), "城市": ("city", "string")}
BID_MAPPING: Columns = {
    "Pack_ID": ("packid", "string"),
    "Display Name1 CN": ("name1", "string"),
    "Display Name2 CN": ("name2", "string"),
    "Display Name3 CN": ("name3", "string"),
}
PRODUCT_NATURE: Columns = {
    "Corp_Desc": ("corp_desc", "string"),
    "厂家性质": ("maker_type", "string"),
    "ATC3_Code": ("atc3", "string"),
    "类别": ("class_name", "string"),
    "Molecule_Desc": ("molecule", "string"),
    "分子": ("molecule_name", "string"),
}
CORPORATION_INFO: Columns = {
    "Corp_Desc": ("corp_desc", "string"),
    "MnfType_Desc": ("maker_type", "string"),
}
PACK_PROFILE: Columns = {
    "Pack_Id": ("packid", "string"),
    "ATC4_Code": ("atc4", "string"),
    "ims_product_cn": ("product_cn", "string"),
}
CITY_NAMES: Columns = {"City": ("city", "string"), "CITY-EN": ("city_en", "string")}
