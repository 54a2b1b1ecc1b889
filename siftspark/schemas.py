"""Record schemas, and the ordered enumerations that statuses, rights and failures are ranked by."""

from __future__ import annotations

# Names and orders of the enumerations.
RIGHTS = ["verified", "open_license", "public_unverified", "restricted", "takedown", "unknown"]
TECHNICAL = ["unknown", "healthy", "partial", "suspect", "dead", "unsupported_environment"]
PUBLICATION = ["stable", "experimental", "withheld", "rejected"]
RELEASE_KINDS = ["bootstrap", "regular", "safety", "rollback"]
SOURCE_KINDS = ["vod_site", "vod_config", "live_playlist", "repository_catalog"]
PARSERS = ["maccms_json", "maccms_xml", "tvbox_json", "tvbox_json5", "m3u", "txt_live", "repository_catalog"]
FETCH_MODES = ["direct_url", "github_tracked_file", "github_repository"]

#: First match wins when statuses are rolled up.
TECHNICAL_ROLLUP = ["healthy", "partial", "suspect", "unknown", "unsupported_environment", "dead"]
PUBLICATION_ROLLUP = ["stable", "experimental", "withheld", "rejected"]
#: Most restrictive first.
RIGHTS_ROLLUP = ["takedown", "restricted", "unknown", "public_unverified", "open_license", "verified"]
#: Worst first, for changes between runs.
TECHNICAL_WORST = ["dead", "unsupported_environment", "unknown", "suspect", "partial", "healthy"]
PUBLICATION_WORST = ["rejected", "withheld", "experimental", "stable"]

#: Failure reasons by priority, the primary one first.
FAILURES = [
    "takedown", "rights_restricted", "terms_changed", "credential_required", "credential_query_rejected",
    "credential_header_rejected", "private_address_rejected", "dangerous_scheme_rejected", "invalid_header_syntax",
    "client_http_disallowed", "client_header_unsupported", "client_extension_unsupported", "unsupported_spider", "http_404",
    "http_410", "dns_failure", "tls_failure", "response_too_large", "invalid_json", "invalid_xml", "schema_incompatible",
    "home_contract_failed", "search_contract_failed", "detail_contract_failed", "play_contract_failed", "media_probe_failed",
    "rate_limited", "upstream_5xx", "fetch_timeout", "unsupported_environment", "blocked_by_source", "missing_upstream",
    "catalog_depth_exceeded", "catalog_limit_exceeded",
]
#: Failures that leave the technical status as it was.
# Fixed values.
KEEPS_STATUS = [
    "takedown", "rights_restricted", "terms_changed", "credential_required", "credential_query_rejected", "credential_header_rejected",
    "private_address_rejected", "dangerous_scheme_rejected", "invalid_header_syntax", "catalog_limit_exceeded",
]
#: Limits of the client: the entity works in part.
# Fixed values.
CLIENT_LIMITS = [
    "client_http_disallowed", "client_header_unsupported", "client_extension_unsupported", "unsupported_spider",
    "media_probe_failed", "catalog_depth_exceeded",
]
# Fixed values.
HARD_FAILURES = [
    "http_404", "http_410", "dns_failure", "tls_failure", "response_too_large", "invalid_json", "invalid_xml",
    "schema_incompatible", "home_contract_failed", "search_contract_failed", "detail_contract_failed", "play_contract_failed",
    "missing_upstream",
]
# Fixed values.
TEMPORARY_FAILURES = ["rate_limited", "upstream_5xx", "fetch_timeout"]
# Fixed values.
REJECTING = [
    "takedown", "rights_restricted", "credential_required", "credential_query_rejected", "credential_header_rejected",
    "private_address_rejected", "dangerous_scheme_rejected", "invalid_header_syntax", "client_http_disallowed", "unsupported_spider",
]
# Fixed values.
WITHHOLDING = ["terms_changed", "client_header_unsupported", "client_extension_unsupported"]

# Fixed values.
SENSITIVE_KEYS = [
    "accesskey", "auth", "authorization", "accesstoken", "apikey", "cookie", "credential", "key", "password", "sig", "sign",
    "signature", "secret", "token", "expires", "expiry", "header", "headers", "httpheader",
]
# What an error page says.
HTML_ERRORS = [
    "captcha", "验证码", "verify you are human", "access denied", "login required", "请登录", "403 forbidden", "404 not found",
    "502 bad gateway", "503 service unavailable",
]
EXECUTABLE_SUFFIX = r"(?i)\.(jar|js|py|dex|so)($|[?#])"
HISTORY = 7
DUE_HOURS = 240

MEDIA = "struct<ok:boolean,final_url:string,response_ms:int,media_path_score:int,width:int,height:int,bandwidth:int,failure_reason:string>"
SOURCES = """id string, kind string, parser string, enabled boolean,
 fetch struct<mode:string,reviewed_url:string,repository_url:string,track_ref:string,config_path:string,reviewed_revision:string>,
 terms_watch array<struct<type:string,url:string,path:string,reviewed_sha256:string>>,
 rights_status string, config_license_status string, content_rights_status string,
 allowed_hosts array<string>, allow_discovered_media_hosts boolean,
 http_exceptions array<struct<host:string,port:int,path_prefix:string,reason:string,reviewed_at:string>>,
 denied_categories array<string>,
 client_site struct<key:string,name:string,searchable:int,quickSearch:int,filterable:int,changeable:int>"""
VOD_RESULTS = """source_id string, key string, name string, type int, api string, searchable int, quick_search int, filterable int,
 changeable int, categories array<string>, rights_status string, declared_headers map<string,string>, raw string, ordinal int,
 technical_status string, publication_status string,
 capabilities struct<home:boolean,search:boolean,detail:boolean,play:boolean,media_probe:boolean>,
 failure_reason string, secondary_reasons array<string>, sample_title string, sample_vod_id string, sample_media_url string"""
LIVE_RESULTS = f"""source_id string, name string, original_url string, normalized_url string, rights_status string, tvg_id string,
 group string, logo string, epg string, declared_headers map<string,string>, ordinal int, technical_status string,
 publication_status string, media {MEDIA}, consecutive_successes int, consecutive_failures int, last_success_at string,
 failure_reason string, secondary_reasons array<string>, response_ms_history array<int>"""
RESPONSES = "url string, with_headers boolean, status int, body binary, final_url string, elapsed_ms int, error string"
NETWORK_PROBES = "group string, passed boolean, attempts int, elapsed_ms int, detail string"
DENYLIST = "id string, source_ids array<string>, hosts array<string>, urls array<string>, reason string, requested_at string, evidence_urls array<string>"
