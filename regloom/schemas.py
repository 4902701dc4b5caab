"""Fixed schemas of the raw and canonical tables."""
from pyspark.sql import types as T

_S = T.StringType()


def _strings(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _S) for n in names.split()])


MANUFACTURER = _strings("name address_raw represented_in_europe site_of_production")
METHOD_TYPE = _strings("action category")
TARGET = _strings("normalized raw")
REFERENCE = _strings("standard raw")

LIST_ROW = _strings(
    "analyte_raw certificate_number commercial_name manufacturer_raw expiry_date_raw status_raw "
    "source label source_page_url detail_page_url matrices_raw reference_method_raw "
    "first_approval_date_raw certificate_issued_by certificate_pdf_url summary_report_pdf_url "
    "unparsed_row")

PAGE_RECORD = T.StructType([
    T.StructField("source", _S), T.StructField("commercial_name", _S),
    T.StructField("manufacturer", MANUFACTURER), T.StructField("method_type", METHOD_TYPE),
    T.StructField("target_organism", TARGET), T.StructField("reference_method", REFERENCE),
    T.StructField("traceability", _strings(
        "source_document_type source_document_url certificate_pdf_url summary_report_pdf_url "
        "extraction_confidence")),
    T.StructField("organism_page_last_updated_raw", _S)])

BOOTSTRAP_RECORD = T.StructType([
    *_strings("certificate_number source commercial_name aim_of_method_raw target_organism action "
              "validation_scope_raw certification_date end_of_validity").fields,
    T.StructField("all_dates_found", T.ArrayType(_S)), T.StructField("raw_block", _S),
    T.StructField("company_holder_raw", _S), T.StructField("source_page", T.IntegerType()),
    T.StructField("provenance", _strings("source_type note pdf_list_valid_on"))])

DISCREPANCY = T.StructType([T.StructField("strain", _S), T.StructField("note", _S)])
PANEL = T.StructType([T.StructField("n_tested", T.IntegerType()),
                      T.StructField("n_correctly_detected", T.IntegerType()),
                      T.StructField("discrepancies", T.ArrayType(DISCREPANCY))])

CERTIFICATE_RECORD = T.StructType([
    *_strings("source certificate_number method_name manufacturer_raw manufacturer_name "
              "manufacturer_address_raw issue_date expiration_date authors_raw "
              "submitting_company_raw independent_laboratory_raw catalog_numbers_raw "
              "target_organism_raw target_organism category_guess matrices_raw").fields,
    T.StructField("matrices", T.ArrayType(_S)),
    *_strings("reference_method_raw original_certification_date "
              "certification_renewal_record_raw").fields,
    T.StructField("inclusivity", PANEL), T.StructField("exclusivity", PANEL),
    *_strings("inclusivity_exclusivity_source_text source_pdf_filename").fields,
    T.StructField("provenance", _strings("source_type note"))])

QUANTITATIVE_ROW = T.StructType([
    T.StructField("category", _S), T.StructField("bias_log", T.DoubleType()),
    T.StructField("sd_log", T.DoubleType()), T.StructField("n_samples", T.IntegerType()),
    T.StructField("n_interpretable", T.IntegerType()),
    T.StructField("lower_limit_95", T.DoubleType()),
    T.StructField("upper_limit_95", T.DoubleType())])
QUALITATIVE_ROW = T.StructType([
    T.StructField("category", _S), T.StructField("sensitivity_alternative_pct", T.DoubleType()),
    T.StructField("sensitivity_reference_pct", T.DoubleType()),
    T.StructField("rlod", T.DoubleType()), T.StructField("relative_trueness_pct", T.DoubleType()),
    T.StructField("false_positive_ratio_alternative_pct", T.DoubleType())])
MATRIX_ROW = T.StructType([
    T.StructField("matrix", _S), T.StructField("sd_repeatability_reference", T.DoubleType()),
    T.StructField("sd_repeatability_alternative", T.DoubleType())])

PERFORMANCE = T.StructType([
    T.StructField("method_nature", _S),
    T.StructField("quantitative", T.StructType([
        T.StructField("relative_trueness_by_category", T.ArrayType(QUANTITATIVE_ROW)),
        T.StructField("accuracy_profile", T.StructType([
            T.StructField("acceptability_limit_log", T.DoubleType()),
            T.StructField("by_matrix", T.ArrayType(MATRIX_ROW))])),
        T.StructField("loq_log", T.DoubleType()),
        T.StructField("inclusivity", PANEL), T.StructField("exclusivity", PANEL)])),
    T.StructField("qualitative", T.StructType([
        T.StructField("method_comparison_by_category", T.ArrayType(QUALITATIVE_ROW)),
        T.StructField("inclusivity", PANEL), T.StructField("exclusivity", PANEL)]))])

CANONICAL = T.StructType([
    T.StructField("id", _S), T.StructField("source", _S),
    T.StructField("source_certificate_number", _S), T.StructField("commercial_name", _S),
    T.StructField("manufacturer", MANUFACTURER), T.StructField("method_type", METHOD_TYPE),
    T.StructField("target_organism", TARGET), T.StructField("reference_method", REFERENCE),
    T.StructField("validation_scope", T.StructType([
        T.StructField("raw", _S), T.StructField("matrices", T.ArrayType(_S)),
        T.StructField("excluded_matrices", T.ArrayType(_S)),
        T.StructField("max_test_portion_g", T.DoubleType())])),
    T.StructField("study_design", T.StructType([
        T.StructField("protocol_standard", _S), T.StructField("study_type", _S),
        T.StructField("number_of_labs", T.IntegerType()),
        T.StructField("number_of_samples", T.IntegerType()),
        T.StructField("expert_laboratory", _S)])),
    T.StructField("certification", T.StructType([
        T.StructField("original_date", T.DateType()),
        T.StructField("renewal_dates", T.ArrayType(_S)),
        T.StructField("extension_dates", T.ArrayType(_S)),
        T.StructField("current_expiry", T.DateType()), T.StructField("status", _S)])),
    T.StructField("performance", PERFORMANCE),
    T.StructField("traceability", _strings(
        "source_document_type source_document_url certificate_pdf_url summary_report_pdf_url "
        "organism_page_last_updated_raw extraction_date extraction_confidence notes"))])

REPORT_PAGE = "doc_id string, page_no int, text string"
REPORT_CELL = ("doc_id string, page_no int, table_no int, row_no int, col_no int, cell string")
WEB_PAGE = "page_id string, url string, html string"
CATALOG_REQUEST = (
    "request_id string, organisms array<string>, manufacturers array<string>, "
    "technologies array<string>, expert_laboratories array<string>, sources array<string>, "
    "statuses array<string>, expires_before string, expires_after string, text string, "
    "answer string, understood boolean")
