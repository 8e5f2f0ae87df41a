"""Labels, column layouts, thresholds and patterns that results depend on."""

# Group labels.
OUR, COMPETITOR = "자사", "경쟁사"
GROUP_LABELS = {
    "OUR": "자사",
    "our": "자사",
    "COMPETITOR": "경쟁사",
    "competitor": "경쟁사",
    "자사": "자사",
    "경쟁사": "경쟁사",
}

# Default brands.
OUR_BRANDS = ["롯데호텔", "호텔롯데", "L7", "시그니엘"]
COMPETITORS = ["신라호텔", "조선호텔"]

# Sources of an article.
PRESS_RELEASE, SIMILAR_TOPIC, GENERAL = "보도자료", "유사주제", "일반기사"

# Classification labels.
BRAND_RELEVANCE = ["관련", "언급", "무관", "판단 필요"]
SENTIMENT_STAGES = ["긍정", "중립", "부정 후보", "부정 확정"]
NEGATIVE_STAGES = ["부정 후보", "부정 확정"]
DANGER_LEVELS = ["상", "중", "하"]
BRAND_ROLES = ["주체", "배경장소", "나열", "무관"]
UNRELATED_CATEGORY = "비관련"
OTHER_CATEGORY = "기타"
NEWS_CATEGORIES = [
    "PR/보도자료", "사업/실적", "브랜드/마케팅", "상품/오퍼링", "제휴/파트너십", "이벤트/프로모션", "시설/오픈",
    "고객 경험", "운영/기술", "인사/조직", "리스크/위기", "ESG/사회", "산업/시장", "기타",
]
ISSUE_CATEGORIES = [
    "안전/사고", "위생/식음", "보안/개인정보/IT", "법무/규제", "고객 분쟁", "서비스 품질/운영",
    "상품/서비스 철수", "가격/상업", "노무/인사", "거버넌스/윤리", "평판/PR", "기타",
]
PR_CATEGORIES = [
    "PR/보도자료", "상품/오퍼링", "제휴/파트너십", "브랜드/마케팅", "이벤트/프로모션", "시설/오픈", "사업/실적", "ESG/사회",
]
MEDIA_TYPES = ["종합지", "경제지", "IT전문지", "방송사", "통신사", "인터넷신문", "기타"]

# Column layouts.
INGEST_COLUMNS = ["query", "group", "title", "description", "pubDate", "originallink", "link"]
RESULT_COLUMNS = [
    "query", "group", "title", "description", "pubDate", "originallink", "link", "pub_datetime", "article_id", "article_no",
    "source", "cluster_id", "cluster_summary", "media_domain", "media_name", "media_group", "media_type",
    "brand_relevance", "brand_relevance_query_keywords", "sentiment_stage", "danger_level", "issue_category",
    "news_category", "news_keyword_summary", "classified_at", "date_only", "week_number", "month", "article_count",
]
UPSERT_FIELDS = [
    "brand_relevance", "brand_relevance_query_keywords", "sentiment_stage", "danger_level", "issue_category",
    "news_category", "news_keyword_summary", "classified_at", "cluster_id", "cluster_summary", "source",
    "media_domain", "media_name", "media_group", "media_type", "date_only", "week_number", "month", "article_count",
]
AUDIT_FIELDS = ["brand_relevance", "sentiment_stage", "source", "media_domain", "date_only"]
DATE_COLUMNS = ["pub_datetime", "date_only", "pubDate", "pub_date", "published_at", "date"]
REASONING_COLUMNS = [
    "article_id", "classified_at", "article_subject", "brand_role", "subject_test", "sentiment_rationale",
    "news_category_rationale", "severity_analysis", "attribution_analysis", "spread_signals", "final_judgment",
]
# Names of the link and of the brand column, in order of preference.
ORIGINAL_LINK_NAMES = ["originallink", "original_link", "original link"]
BRAND_NAMES = ["brand_relevance", "brand relevance"]
FIRST_REASONS, SECOND_REASONS = REASONING_COLUMNS[2:7], REASONING_COLUMNS[7:]
LOG_COLUMNS = ["run_id", "timestamp", "category", "stage", "message", "data_json"]
KEYWORD_COLUMNS = ["sentiment_stage", "danger_level", "issue_category", "news_category", "brand_relevance"]
RUN_HISTORY_COLUMNS = [
    "run_id", "timestamp", "run_mode", "cli_args",
    "articles_collected_total", "articles_collected_per_query", "existing_links_skipped", "duration_collection",
    "reprocess_targets_total", "reprocess_missing_from_result", "reprocess_field_missing",
    "articles_processed", "duplicates_removed", "articles_filtered_by_date",
    "press_releases_detected", "press_release_groups", "press_release_avg_cluster_size",
    "media_domains_total", "media_domains_new", "media_domains_cached", "duration_processing",
    "pr_clusters_analyzed", "pr_articles_propagated", "pr_llm_success", "pr_llm_failed", "pr_cost_estimated", "duration_pr_classification",
    "articles_classified_llm", "llm_api_calls", "classification_errors", "press_releases_skipped", "llm_cost_estimated",
    "duration_general_classification",
    "sv_clusters_verified", "sv_kept_press_release", "sv_reclassified_similar_topic", "sv_cross_merged_groups",
    "sv_cross_merged_articles", "sv_new_topic_groups", "sv_new_topic_articles", "sv_llm_verified", "sv_llm_rejected",
    "duration_source_verification",
    "our_brands_relevant", "our_brands_negative", "danger_high", "danger_medium", "competitor_articles", "total_result_count",
    "sheets_sync_enabled", "sheets_rows_uploaded_raw", "sheets_rows_uploaded_result", "duration_sheets_sync",
    "errors_total", "duration_total",
]

# Patterns (Java syntax).
INVISIBLE = (
    r"[\x{feff}\x{fffe}\x{200b}-\x{200f}\x{2028}-\x{202f}\x{2060}\x{180e}\x{00a0}\x{3000}\x{00ad}\x{fff9}-\x{fffc}"
    r"\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]"
)
TOKEN = r"[가-힣a-z0-9]+"
