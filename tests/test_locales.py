from pyspark.sql import functions as F

from shelfmark.operators.locales import CATALOGUES, catalogue_frame, resolve_locales

# The locales a shop can be set to.
LOCALES = """
af_ZA ar_DZ ar_EG ar_KW ar_MA ar_SA az_Latn_AZ be_BY bg_BG bn_BD bs_Latn_BA ca_ES cs_CZ cy_GB da_DK de_AT de_CH de_DE
de_LU el_GR en_AU en_CA en_GB en_IE en_NZ en_US es_AR es_BO es_CL es_CO es_CR es_ES es_MX es_PA es_PE es_US es_VE et_EE
eu_ES fa_IR fi_FI fil_PH fr_BE fr_CA fr_CH fr_FR fr_LU gl_ES gu_IN he_IL hi_IN hr_HR hu_HU id_ID is_IS it_CH it_IT
ja_JP ka_GE km_KH ko_KR lo_LA lt_LT lv_LV mk_MK mn_Cyrl_MN ms_Latn_MY ms_MY nb_NO nl_BE nl_NL nn_NO pl_PL pt_BR pt_PT
ro_RO ru_RU sk_SK sl_SI sq_AL sr_Cyrl_RS sr_Latn_RS sv_FI sv_SE sw_KE th_TH tr_TR uk_UA vi_VN zh_Hans_CN zh_Hant_HK
zh_Hant_TW
""".split()

ANSWERS = {
    "de_DE": "de_DE", "pt_BR": "pt_BR", "de_AT": "de_DE", "fr_CA": "fr_FR", "ja_JP": "ja", "zh_Hans_CN": "zh_CN",
    "zh_Hant_TW": None, "zh_Hant_HK": None, "sr_Cyrl_RS": None, "de_CH": "de_DE", "es_AR": "es_ES", "en_AU": None,
    "pt_AO": None, "uk_UA": "uk", "en_US": None, "en": None, "en_GB": "en_GB", "en-gb": "en_GB", " de ": "de_DE",
    "": None, "   ": None, "xx_YY": None, "klingon": None, "../../etc/passwd": None, "de/../../x": None, "zz": None,
    "DE_de": "de_DE", "fi": "fi", None: None,
}


def resolve(spark, locales):
    rows = spark.createDataFrame([(x,) for x in locales], "locale string")
    return {r.locale: r.catalogue for r in resolve_locales(rows, catalogue_frame(spark)).collect()}


def test_definite_answers(spark):
    assert resolve(spark, ANSWERS) == ANSWERS


def test_every_locale_resolves_to_a_catalogue_or_nothing(spark):
    assert len(LOCALES) == 92 and len(CATALOGUES) == 23
    got = resolve(spark, LOCALES)
    assert set(got) == set(LOCALES) and all(v is None or v in CATALOGUES for v in got.values())
