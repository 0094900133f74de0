"""Fixed values.

Words, limits and patterns that occur in the ledgers themselves. They are data:
results only agree with the source systems when these stay exactly as written.
"""

# --- words -------------------------------------------------------------------
MASK = "*****"
SHORTENED = "{}... (长度: {}字符)"
YES = "是"
NO = "否"
CASH = "全款"
HOST_STORE = "直播基地"
TEAM_TRANSFER = "调拨"
TEAM_OTHER = "其他"
FINANCE_TRANSFER_OUT = "调出车"
SERIES_TRANSFER = "调拨车"
USED_CAR = "二手车返利"
GUIZHOU = "贵州"
CHENGDU = "成都"
FILM = "膜"
BRAND_FILM = "龙膜"
COMPANY_FUNDED = "公司"
NOT_SHIPPED = "未发"
IN_TRANSIT = "在途"
IN_STOCK = "在库"
PLANNED = "计划"
DATE_EMPTY = "日期为空"
DATE_MISSING = "缺少日期"
NOT_VISITED = "未到店"
APPROVED = "审核通过"
REJECTED = "审批驳回"
CLEARED = "已清"
RECEIVED = "已收款"
AWAITING = "待收款"
VALID = "有效"
PRE_SALES = "售前"
CASH_AND_CARRY = "现定现交"
INTERNAL_IN, EXTERNAL_IN = "内部调入", "外部调入"
INTERNAL_OUT, EXTERNAL_OUT = "内部调出", "外部调出"
COMPLIANT, NOT_COMPLIANT = "符合", "不符合"
KEY_ACCOUNT, NOT_KEY_ACCOUNT = "大客户", "非大客户"
VEHICLE_SALE_DOC = "车辆销售单"
IN_FORCE = "生效"
TRAVEL_VERSION = "畅行版"
TRAVEL_PATTERN = "畅行.*"
SCORE_WORD, FACTOR_WORD = "得分", "折让系数"
UNNAMED = "Unnamed"

# --- word lists --------------------------------------------------------------
REFUNDED_STATES = ["已退款", "已退货", "已换货", "全退款", "全退货", "部分退款"]
FILM_REFUNDED_STATES = ["已换货", "已退货", "已退款"]
GIFT_DOC = "新车销售"
ZERO_GIFT_DOCS = ["客户增购", "换货销售", "独立销售"]
PACKAGE_EXCLUDED = "保赔无忧"
PACKAGE_LIFETIME = "终身保养"
PACKAGE_CLOSED_STATES = ["已退卡", "已登记"]
ZERO_INTEREST_PLANS = ["交行信用卡中心5免2-9%", "建行5免2"]
SUBSIDISED_WORD, UNSUBSIDISED_WORD = "贴息", "非贴息"
LOAN_SUBSIDISED, LOAN_UNSUBSIDISED = "厂家贴息贷", "厂家非贴息贷"
LOAN_ZERO, LOAN_PLAIN = "无息贷", "非贴息贷"
VOID_IGNORED = ["重复录入", "错误录入"]
DASHBOARD_TEAMS_DROPPED = ["调拨", "其他", "二手车返利"]
APP_TEAMS_DROPPED = ["调拨", "其他", "试驾"]
EXPORT_TEAMS = ["调拨", "其他"]
INSURER_WORD = "鼎和"
EXCLUDED_PREMIUMS = [1000.0, 1130.0, 1800.0]
COST_CATEGORY_DROPPED = "随车"
BANK_KEYWORDS = ["光大", "中信", "兴业", "平安", "交通", "工商", "招商"]
NULL_WORDS = ["nan", "NaN", "NAN"]
SALE_PSEUDO_SERIES = ["二手车返利", "调拨"]
UNIT_CASE = {"km": "KM", "plus": "Plus", "e2": "E2"}
DELETE_BY_ID_TITLE = "删除装饰业务数据"
DELETE_BY_OUT_ID_TITLE = "删除装饰出库数据"

# --- money rules -------------------------------------------------------------
VAT_DIVISOR, VAT_RATE, SURCHARGE = 1.13, 0.13, 1.12
SERVICE_DIVISOR, SERVICE_RATE = 1.06, 0.06
GUIZHOU_PROMO = 200.0
CASH_AND_CARRY_DEPOSIT = 3000.0
GIFT_COMMISSION_CUT = 200.0
MONEY_WORDS = ["amount", "profit", "fee", "price", "cost", "rebate", "subsidy", "gross"]

# --- bands and classes ---------------------------------------------------------
PRICE_EDGES = [0, 100000, 150000, 200000, 250000, 300000, 350000]
PRICE_LABELS = ["0-10万", "10-15万", "15-20万", "20-25万", "25-30万", "30-35万", "35-40万"]
STOCK_AGE = [
    (180, "180天以上"),
    (120, "120-180天"),
    (90, "90-120天"),
    (60, "60-90天"),
    (30, "30-60天"),
]
STOCK_AGE_YOUNG = "30天以下"
STOCK_NOT_ARRIVED = "未到库"

# --- dates -------------------------------------------------------------------
CUTOVER = "2025-04-01"
TERMINAL_RULE_DATE = "2026-03-01"
CATEGORY_RULE_DATE = "2026-01-01"
EXCEL_EPOCH = "1899-12-30"
RULE_EPOCH = "1900-01-01"
EVENING_HOUR = 20
