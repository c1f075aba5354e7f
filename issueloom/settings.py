"""Thresholds of the jobs. Every job takes a Settings value, so that a run can change them."""

from __future__ import annotations

from dataclasses import dataclass, field


# Weights, factors, limits and display tables that decide results.
CATEGORY_WEIGHTS = {
    "RATE": 100, "MACRO": 80, "POLICY": 70, "FX": 60, "COMMODITY": 60,
    "GEO": 60, "MARKET": 55, "EARNINGS": 40, "ETC": 10,
}
CATEGORY_ORDER = ["RATE", "EARNINGS", "MACRO", "COMMODITY", "FX", "MARKET", "POLICY", "GEO", "ETC"]
MAGNITUDE_FACTORS = [("변동폭", 0.4), ("상승률", 1.2), ("급등", 1.2), ("변동", 0.4)]
COMPANY_GROUPS = ["kr_companies", "us_companies"]
INSTITUTION_GROUP = "institutions"
AUXILIARY_METRIC = "변동폭"
BANNED_PHRASES = ["급등 확실", "급락 확실", "무조건", "전량 매수", "전량 매도", "반드시 오", "반드시 내"]
HARD_WORDS = ["유동성", "수급", "순매수", "변동성", "디폴트", "헤지", "스프레드", "벤치마크",
              "지정학", "통화량", "긴축", "밸류에이션", "컨센서스", "펀더멘털"]
NOISE_PATTERN = (
    "(insider (selling|buying|trade|transaction)|13F|form 4|analyst (rating|estimate)|price target|"
    "(raises|lowers|cuts|boosts) (price )?target|buy rating|sell rating|hold rating|overweight|underweight|"
    "reiterat|initiates coverage|shares (bought|sold)|stake in|position in|holdings in|acquires shares|"
    "short interest|dividend (increase|announcement)|ex-dividend|여행|관광|호텔 예약|항공권|맛집|레시피|"
    "스포츠|연예|날씨)"
)
NOTICE_PATTERN = (
    "(개최|행사|안내|모집|공모|채용|시상|수상|기념식|기념행사|포럼|세미나|간담회|워크숍|설명회|박람회|축사|"
    "기고|말씀|인사말|담화문|임명|위촉|인사발령|MOU|업무협약|캠페인|봉사|체험|공휴일|휴무)"
)
EARNINGS_PATTERN = "(잠정실적|영업(잠정)?실적|분기보고서|반기보고서|사업보고서)"
RESULTS_ITEM_PATTERN = r"(2\.02|Results of Operations)"
FILING_FORMS = ["8-K", "10-Q", "10-K"]
REPORT_QUARTER = {"11013": "1Q", "11012": "2Q", "11014": "3Q", "11011": "4Q"}
REVENUE_TAGS = ["RevenueFromContractWithCustomerExcludingAssessedTax", "Revenues", "SalesRevenueNet"]
OPERATING_INCOME_TAGS = ["OperatingIncomeLoss"]
DEFAULT_ICON = "📰"
CATEGORY_ICONS = {
    "RATE": "🏦", "MACRO": "🌡️", "POLICY": "🏛️", "FX": "💱", "COMMODITY": "🛢️",
    "GEO": "🌍", "MARKET": "📈", "EARNINGS": "🧾", "ETC": "📰",
}
TIER_BASE = {"weekly": 3000, "monthly": 2000, "yearly": 1000}
STAT_DIRECTIONS = ["up", "down", "flat"]
EFFECT_DIRECTIONS = ["up", "down", "info"]

# Fixed values of the chart registry: type, categories, chart, unit, source, months kept,
# keywords and tolerance of the consistency rule (None where there is no rule).
VISUALS = [
    ("kr_base_rate", ["RATE"], "step", "%", "한국은행 ECOS", 36, None, None),
    ("us_policy_rate", ["RATE"], "step", "%", "FRED", 36, None, None),
    ("us_10y", ["RATE", "MARKET"], "line", "%", "FRED", 12, None, None),
    ("us_cpi_yoy", ["MACRO"], "line", "%", "FRED", 36, None, None),
    ("kr_cpi_yoy", ["MACRO"], "line", "%", "한국은행 ECOS", 36, None, None),
    ("usdkrw", ["FX"], "line", "원", "한국은행 ECOS", 6, ["환율", "원/달러", "원달러"], 0.05),
    ("wti", ["COMMODITY"], "line", "달러", "FRED", 12, ["유가", "원유", "WTI"], 0.12),
    ("earnings_quarterly", ["EARNINGS"], "bar", "", "DART/EDGAR", None, None, None),
    ("kospi_close", ["MARKET"], "line", "pt", "금융위 시세정보", 3, ["코스피", "KOSPI"], 0.10),
]


@dataclass(frozen=True)
class Settings:
    # clustering
    tau_join: float = 0.82
    tau_hold: float = 0.74
    hold_max_tries: int = 2
    active_window_h: int = 72
    centroid_alpha: float = 0.10
    half_precision: bool = True  # vectors have the precision of their two-byte storage at every step
    merge_sim: float = 0.86
    min_publish: int = 2
    gate_allow_empty: bool = True
    max_members: int = 40
    centroid_freeze_members: int = 20
    hold_expiry: str = "intended"  # or "observed": an expired hold keeps its count and is never seeded
    # duplicates
    simhash_k: int = 3
    dup_window_h: int = 48
    # lifecycle
    stale_h: int = 72
    archive_d: int = 30
    seed_pool_ttl_h: int = 72
    # vectors
    dim: int = 384
    vector_prefix: str = "query: "
    max_vectors_per_run: int | None = None  # a limit for costly models; the rest waits for the next run
    # classification
    proto_min: float = 0.35
    # summaries
    daily_cap: int = 300
    max_per_run: int = 40
    max_headlines: int = 5
    template_retry_h: int = 3
    # scoring
    institution_bonus: int = 30
    company_bonus: int = 25
    source_per: int = 5
    source_cap: int = 25
    official_bonus: int = 10
    magnitude_cap: int = 40
    recency_hours: int = 24
    recency_step: int = 5
    recency_cap: int = 30
    category_weights: dict = field(default_factory=lambda: dict(CATEGORY_WEIGHTS))
    magnitude_factors: tuple = tuple(MAGNITUDE_FACTORS)
    # sources and series
    lookback_h: int = 26
    seen_keep: int = 5000
    cache_h: int = 6
    rate_min_delta: float = 0.05
    macro_months: int = 3
    window_days: int = 3
    per_event: int = 25
