"""Vocabularies that the operators' results depend on."""

NON_ORIGINAL_TYPES = (
    "review", "systematic review", "meta-analysis", "editorial", "comment",
    "news", "letter", "published erratum", "retracted publication",
)

ORIGINAL_OR_UNCLEAR_TYPES = (
    "journal article", "clinical trial", "clinical trial, phase i", "clinical trial, phase ii",
    "clinical trial, phase iii", "clinical trial, phase iv", "comparative study", "evaluation study",
    "observational study", "validation study", "multicenter study",
)

QUOTAS = {"candidate_priority": 300, "non_priority_original_or_unclear": 200, "obvious_non_original": 100}

RECORD_ENUMS = {
    "disease": ("cancer", "non-cancer", "unclear"),
    "study": ("original research", "review", "commentary", "method", "unclear"),
    "primary_contribution": ("biological discovery", "clinical discovery", "computational method", "experimental mechanism", "resource/atlas", "other"),
    "new_experimental_data": ("none", "limited", "substantial", "unclear"),
    "public_data_reuse": ("none", "minor", "major", "unclear"),
    "relevance": ("YES", "MAYBE", "NO"),
}

MODALITIES = ("scRNA", "bulk RNA", "spatial", "genomics", "epigenomics", "proteomics", "multiomics", "pathology", "other")

PROVENANCE_FIELDS = ("model", "prompt_version", "screened_at")

SEMANTIC_FIELDS = (
    "pmid", "disease", "study", "primary_contribution", "data_modalities", "computational_centrality",
    "new_experimental_data", "public_data_reuse", "relevance", "confidence", "rationale",
)

VISIBLE_FIELDS = ("pmid", "doi", "title", "abstract", "article_types", "mesh_terms")

FULL_TEXT_STATUSES = (
    "downloaded", "downloaded_with_si", "open_access_downloaded",
    "full_text_html_available", "available_not_downloaded",
    "carsi_waiting_user", "carsi_resolved_retry_needed",
    "publisher_verification_waiting_user", "sciencedirect_robot_check",
    "retry_after_user_verification", "do_not_auto_retry",
    "url_needs_repair", "library_no_permission", "no_full_text_link",
    "publisher_blocked_waiting_user", "no_authorized_pdf_found",
    "pdf_fetch_failed", "failed_after_retry",
)

SI_STATUSES = ("not_checked", "available_not_downloaded", "downloaded", "not_found")

STATUSES = ("pending", "running", "complete", "failed")

CANCER_RULES = (
    r"\bcancers?\b", r"\btumou?rs?\b", r"\bneoplas(?:m|ms|ia|tic)\b", r"\bcarcinomas?\b", r"\badenocarcinomas?\b",
    r"\bsarcomas?\b", r"\bleuk(?:a|e)mias?\b", r"\blymphomas?\b", r"\bmelanomas?\b", r"\bmyelomas?\b",
    r"\bgliomas?\b", r"\bglioblastomas?\b", r"\bmalignan(?:t|cy|cies)\b", r"\boncolog(?:y|ic|ical)\b", r"\bmetasta(?:sis|ses|tic)\b",
)

OMICS_RULES = (
    r"\bgenom(?:e|es|ic|ics)\b", r"\btranscriptom(?:e|es|ic|ics)\b", r"\bsingle[- ]cell\b", r"\bsingle[- ]nucle(?:us|i)\b",
    r"\bscRNA(?:-seq)?\b", r"\bsnRNA(?:-seq)?\b", r"\bspatial (?:transcriptom|omics|profiling)\w*\b", r"\bproteom(?:e|es|ic|ics)\b",
    r"\bmetabolom(?:e|es|ic|ics)\b", r"\bepigenom(?:e|es|ic|ics)\b", r"\bmethyl(?:ation|ome|omic)\b", r"\bATAC(?:-seq)?\b",
    r"\bchromatin accessibility\b", r"\bmulti[- ]?omics?\b", r"\bpan[- ]?omics?\b", r"\bmolecular profil(?:e|es|ing)\b",
    r"\bRNA[- ]?seq(?:uencing)?\b", r"\bwhole[- ](?:genome|exome) sequencing\b", r"\bW[EG]S\b",
    r"\bcopy[- ]number (?:alteration|variation|profile)\w*\b", r"\bsomatic (?:mutation|variant)\w*\b",
)
