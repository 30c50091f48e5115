"""The reference's question-specific keyword rules (relevance by keywords).

Fixed values: the rule table of the reference's ten breast-cancer questions,
as published with it; a decisive keyword found in a result gives gain 2, two or
more supportive keywords give gain 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.operators.relevance import keyword_rules_frame

# Fixed values (must equal the reference's rule table).
REFERENCE_KEYWORDS = {
    "q1": {
        "decisive": ["invasive ductal carcinoma", "er positive", "pr positive", "her2 negative",
                     "lumpectomy", "sentinel lymph node", "breast conserving", "breast conservation"],
        "supportive": ["breast cancer treatment", "surgical", "mastectomy", "radiation", "ductal",
                       "hormone receptor", "staging", "biopsy"],
    },
    "q2": {
        "decisive": ["trastuzumab", "her2", "herceptin", "her-2", "erbb2", "her2-positive",
                     "her2 amplification", "her2 overexpression"],
        "supportive": ["targeted therapy", "breast cancer", "molecular marker", "receptor", "response"],
    },
    "q3": {
        "decisive": ["brca1", "brca2", "prophylactic mastectomy", "risk reducing", "salpingo-oophorectomy",
                     "bilateral mastectomy", "risk reduction"],
        "supportive": ["genetic mutation", "hereditary", "family history", "ovarian cancer",
                       "cancer risk", "prevention"],
    },
    "q4": {
        "decisive": ["aromatase inhibitor", "aromatase", "androgen to estrogen", "peripheral conversion",
                     "anastrozole", "letrozole", "exemestane", "estrogen synthesis"],
        "supportive": ["postmenopausal", "hormone receptor", "endocrine therapy", "breast cancer",
                       "estrogen", "mechanism"],
    },
    "q5": {
        "decisive": ["inflammatory breast cancer", "peau d'orange", "skin erythema", "skin edema",
                     "orange peel", "inflammatory carcinoma"],
        "supportive": ["breast cancer", "clinical features", "erythema", "edema", "skin changes",
                       "aggressive"],
    },
    "q6": {
        "decisive": ["brca1", "triple negative", "triple-negative", "basal-like", "basal",
                     "tnbc", "brca1 mutation"],
        "supportive": ["histological subtype", "breast cancer", "mutation", "hereditary",
                       "receptor negative"],
    },
    "q7": {
        "decisive": ["cdk4/6 inhibitor", "cdk4", "cdk6", "palbociclib", "ribociclib", "abemaciclib",
                     "er positive metastatic", "endocrine resistance"],
        "supportive": ["metastatic breast cancer", "aromatase inhibitor", "tamoxifen", "progression",
                       "treatment strategy", "hormone therapy"],
    },
    "q8": {
        "decisive": ["sentinel lymph node", "axillary staging", "axillary lymph node dissection",
                     "slnb", "alnd", "sentinel node biopsy"],
        "supportive": ["early stage breast cancer", "lymph node", "staging", "axilla", "metastasis"],
    },
    "q9": {
        "decisive": ["paget disease", "paget's disease", "nipple", "underlying carcinoma",
                     "underlying malignancy", "dcis", "ductal carcinoma in situ"],
        "supportive": ["breast cancer", "nipple lesion", "areola", "breast malignancy"],
    },
    "q10": {
        "decisive": ["early menarche", "late menopause", "risk factor", "estrogen exposure",
                     "nulliparity", "hormone exposure", "age at menarche"],
        "supportive": ["breast cancer risk", "increased risk", "developing breast cancer",
                       "reproductive", "hormonal"],
    },
}


def reference_rules(spark: SparkSession) -> DataFrame:
    """(qid, tier, keyword) for the reference question set."""
    return keyword_rules_frame(spark, REFERENCE_KEYWORDS)
