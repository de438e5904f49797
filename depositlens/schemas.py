"""Declared schemas. Nothing is inferred: inference costs a pass and guesses types.

Money columns ending in ``_manyen`` are in units of 10,000 yen.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)
QUANTITY = T.DecimalType(18, 6)
PRICE = T.DecimalType(12, 2)

BRANCH = T.StructType(
    [
        T.StructField("branch_id", T.StringType()),
        T.StructField("branch_name", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("prefecture", T.StringType()),
    ]
)

EMPLOYEE = T.StructType(
    [
        T.StructField("employee_id", T.StringType()),
        T.StructField("employee_name", T.StringType()),
        T.StructField("branch_id", T.StringType()),
        T.StructField("role", T.StringType()),
    ]
)

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("segment", T.StringType()),
        T.StructField("deposit_balance_manyen", MONEY),
        T.StructField("managed_asset_manyen", MONEY),
        T.StructField("birth_date", T.DateType()),
        T.StructField("branch_id", T.StringType()),
        T.StructField("employee_id", T.StringType()),
        T.StructField("phone_number", T.StringType()),
    ]
)

CONTACTS = T.StructType(
    [
        T.StructField("contact_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("contact_date", T.DateType()),
        T.StructField("channel", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("result", T.StringType()),
    ]
)

CUSTOMER_VOICE = T.StructType(
    [
        T.StructField("voice_id", T.LongType()),
        T.StructField("received_date", T.DateType()),
        T.StructField("channel", T.StringType()),
        T.StructField("voice_text", T.StringType()),
    ]
)

# Only the comment file holds free text that may contain line breaks.
FREE_TEXT_TABLES = frozenset({"customer_voice"})

BRONZE = {
    "customers": CUSTOMERS,
    "branch": BRANCH,
    "employee": EMPLOYEE,
    "customer_voice": CUSTOMER_VOICE,
    "contacts": CONTACTS,
}

# Japanese display names of the English columns.
DISPLAY_NAMES = {
    "customer_id": "顧客ID",
    "name": "氏名",
    "age": "年齢",
    "segment": "顧客セグメント",
    "deposit_balance_manyen": "預金残高(万円)",
    "managed_asset_manyen": "預かり資産残高(万円)",
    "birth_date": "生年月日",
    "branch_id": "メイン店舗ID",
    "employee_id": "担当者ID",
    "voice_id": "声ID",
    "received_date": "受付日",
    "channel": "チャネル",
    "voice_text": "本文",
}

# The same with headings of our own for the columns that the joins and labels add, and for contacts.
SILVER_DISPLAY_NAMES = DISPLAY_NAMES | {
    "phone_number": "電話番号",
    "branch_name": "店舗名",
    "area": "エリア",
    "prefecture": "都道府県",
    "employee_name": "担当者名",
    "sentiment": "感情",
    "contact_id": "接触ID",
    "contact_date": "接触日",
    "product": "商品",
    "result": "結果",
}
