"""The code lists and limits that the source system allows."""

GENDERS = ("female", "male", "non-binary")
AGE_GROUPS = ("18-24", "25-34", "35-44", "45-54", "55+")
CHANNELS = ("direct", "email_campaign", "organic_search", "paid_search", "referral", "social_media")
REGIONS = ("central", "east", "west")
CATEGORIES = ("casual", "genz", "outdoor", "streetwear")
SEGMENTS = ("activewear", "all-weather", "balanced", "everyday",
            "performance", "premium", "standard", "trendy")
SIZES = ("s", "m", "l", "xl")
ORDER_STATUSES = ("created", "paid", "shipped", "delivered", "returned", "cancelled")
SHIPPED_STATUSES = ("delivered", "returned", "shipped")
PAYMENT_METHODS = ("apple_pay", "bank_transfer", "cod", "credit_card", "paypal")
PROMO_TYPES = ("fixed", "percentage")
PROMO_CHANNELS = ("all_channels", "email", "in_store", "online", "social_media")
RETURN_REASONS = ("changed_mind", "defective", "late_delivery", "not_as_described", "wrong_size")
MIN_RATING, MAX_RATING = 1, 5
MAX_PERCENTAGE = 100

NO_PROMO = "NO_PROMO"
NO_PROMO_NAME = "Không áp dụng khuyến mãi"
NO_PROMO_CODE = "none"
