"""Names, codes, texts and patterns that results must carry exactly."""

# Column names expected in a period's source file, in order.
SOURCE_HEADERS = [
    "Invoice",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "Price",
    "Customer ID",
    "Country",
]

# Stock codes that are services or tests, not merchandise.
NON_MERCHANDISE_CODES = [
    "ADJUST",
    "BANK CHARGES",
    "C2",
    "D",
    "DCGS0003",
    "DOT",
    "M",
    "POST",
    "S",
    "TEST001",
    "TEST002",
]

# Segment codes and their display names.
SEGMENT_NAMES = {
    "CHAMPIONS": "重要价值客户",
    "LOYAL": "重要保持客户",
    "POTENTIAL": "重要发展客户",
    "NEW": "新客户",
    "AT_RISK": "重要挽留客户",
    "HIBERNATING": "流失风险客户",
    "PROMISING": "潜力客户",
    "GENERAL": "一般客户",
}

# The scope that covers every customer.
ALL_SCOPE = "ALL"
ALL_SCOPE_NAME = "全部客户"

# Name shown for a product without any name in the rule catalogue, and in product profiles.
UNNAMED_IN_RULES = "未知商品"
UNNAMED_IN_PROFILES = "UNKNOWN PRODUCT"

# Row origins and model name of generated rows.
ORIGIN_REAL = "REAL"
ORIGIN_GENERATED = "MODEL_GENERATED"
GENERATION_MODEL = "segmentAwareCooccurrenceV1"

# Texts of the recommendation report.
STRATEGY_BUNDLE = "组合折扣"
STRATEGY_CROSS_SELL = "交叉销售"
STRATEGY_PREDICTED = "预测组合"
PREDICTED_SCOPE_NAME = "模型预测场景"
SOURCE_SEGMENT_RULE = "SEGMENT_RULE"
SOURCE_GLOBAL_RULE = "GLOBAL_RULE_FALLBACK"
SOURCE_PREDICTION = "MODEL_PREDICTION"
BASIS_RULES = "REAL_AND_MODEL_AUGMENTED"
RULE_REASON = "历史置信度{confidence}%，提升度{lift}，覆盖{coverage}张购物篮"
PREDICTION_REASON = "模型增强场景置信度{confidence}%，提升度{lift}，覆盖{coverage}张预测购物篮"
