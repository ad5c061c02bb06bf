"""Fixed values.

Word lists, thresholds, patterns and texts in this module are part of the
expected results: changing one changes what the operators return.  Every
operator takes them as default arguments, so a caller may pass others.
"""

# --- header hierarchy -----------------------------------------------------
PATH_SEPARATOR = "-"
PAYEE_SUFFIX = ".支払先"
GROUP_MARKER = "グループ"
ID_PARTS = ("事業番号-1", "事業番号-2", "事業番号-3")

# --- keyword search over headers ------------------------------------------
EXPLORE_KEYWORD = "支出"

KEYWORD_HYPOTHESIS = {
    "project_id": ["事業番号", "事業№", "通し番号", "事業No", "整理番号"],
    "project_name": ["事業名", "件名", "事業・施策名"],
    "year": ["年度"],
    "budget_amount": ["予算", "要求額", "決定額", "当初予算", "補正予算"],
    "expenditure_amount": ["支出", "執行額", "支出済額", "支出額"],
    "governing_agency": ["府省庁", "府省", "実施機関", "所管"],
}

METADATA_TARGETS = {
    "project_id": ["事業番号"],
    "project_name": ["事業名"],
    "governing_agency": ["府省名", "府省庁", "府省"],
    "year": ["年度"],
    "budget_initial": ["当初予算"],
    "budget_supplementary": ["補正予算"],
    "expenditure_final": ["執行額", "支出済額"],
}
UNIQUE_TARGETS = ("project_id", "project_name")
YEAR_TARGETS = ("year",)

# --- header ranking -------------------------------------------------------
RANK_CATEGORIES = (("支出済額", "執行額"), ("支出額",))
RANK_FALLBACK = "支出"
RANK_EXCLUSIONS = (
    "評価", "説明", "理由", "概要", "有無", "法人番号", "契約方式",
    "落札率", "入札者数", "応募者数", "チェック欄", "部局",
)
RANK_LAST_PART = ("支出額", "支出済額", "執行額")
QUESTION_PATTERN = "か。?$"

# --- key columns ----------------------------------------------------------
DIAGNOSE_KEYWORDS = ("事業番号", "整理番号", "番号", "ID", "コード")
DIAGNOSE_EXCLUSIONS = ("法人番号",)
KEY_TRUMPS = ("事業番号", "事業番号-1")
KEY_KEYWORDS = ("事業番号", "整理番号", "番号", "ID")
KEY_BONUS = ("事業",)
KEY_EXCLUSIONS = ("関連", "過去", "点検", "改善", "レビューシート", "法人", "郵便", "支出先")
KEY_MIN_UNIQUENESS = 0.3
KEY_MIN_SCORE = -500
SAMPLE_ROWS = 500
SAMPLE_VALUES = 5

# Cell texts that the sampled key jobs and the separation job treat as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# --- repeated groups ------------------------------------------------------
REPEATED_GROUP_PATTERN = r"支出先上位.*?リスト-([A-Z\d]+)\..*?-(\d+)-(.+)"
ATTRIBUTE_NAMES = {
    "支出額（百万円）": "expenditure_amount_jpy_million",
    "支出先": "supplier_name",
    "法人番号": "supplier_corporate_id",
    "業務概要": "contract_summary",
}

# --- profiles -------------------------------------------------------------
LENGTH_BINS = (0, 1, 10, 50, 100, 250, 500, 1000, 5000)
DOMINANCE = 0.95

# --- documents and retrieval ----------------------------------------------
PAIR_SEPARATOR = "。 "
NAME_VALUE_SEPARATOR = ": "
CHUNK_BYTES = 10 * 1024 * 1024
CHUNK_MARK = "_chunk_"
PREVIEW_CHARS = 200
ANSWER_PREVIEW_CHARS = 1000
TOP_K = 5
BM25_K1 = 0.9
BM25_B = 0.4
CONTEXT_SEPARATOR = "\n\n---\n\n"
PROMPT_TEMPLATE = """
あなたは非常に優秀で、誠実な行政アナリストです。
以下の参考情報に厳密に基づいて、ユーザーの質問に日本語で回答してください。
参考情報に答えがない場合、または情報が不十分な場合は、「参考情報からは分かりませんでした」と正直に回答してください。
あなた自身の知識や意見を付け加えてはいけません。

---
【参考情報】
{context}
---

【ユーザーの質問】
{query}
---

【回答】
"""
