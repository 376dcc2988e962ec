"""modspark: reviewing user content at scale with PySpark DataFrames."""

from modspark.operators.classifier import ClassifierModel, fit_classifier, load_classifier, prompt_safety
from modspark.operators.flatten import (
    celebrities,
    faces,
    image_text,
    moderation_labels,
    pii_rows,
    toxicity_segments,
    video_celebrities,
    video_face_matches,
    video_faces,
    video_labels,
    video_metadata,
    video_moderation,
    video_persons,
)
from modspark.operators.matching import face_search, face_search_cost, match_jobs, unmatched_notices
from modspark.operators.policy import (
    child_safety,
    load_policy,
    parse_json_verdict,
    parse_line_verdict,
    parse_policy,
    policy_phrases,
    policy_verdict,
    render_prompts,
    with_judged,
    with_stem_hits,
)
from modspark.operators.routing import (
    exact_scores,
    flag_decision,
    has_text,
    min_confidence,
    needs_translation,
    negative_flag,
    only_lines,
    review_decision,
    route_modalities,
    split_finished_jobs,
    unsupported_objects,
    with_extension,
    with_result_key,
    with_transcript_key,
    with_uri,
)
from modspark.operators.scoring import (
    detect_language,
    pii_entities,
    resolve_english,
    sentiment,
    toxicity,
    with_pii,
    with_tokens,
)
from modspark.operators.select import (
    confident_text,
    first_pii,
    first_segment,
    full_transcript,
    image_age,
    line_list,
    line_pii,
    result_page,
    timeline,
    top_language,
    with_result_page,
)
from modspark.plans.audio import moderate_audio
from modspark.plans.image import gather_detections, image_record, moderate_image, parse_image_documents
from modspark.plans.objects import moderate_objects, routed_objects
from modspark.plans.replies import analyze_replies, dominant_language, first_class, toxic_result
from modspark.plans.text import analyze_text, moderate_text, safety_record, text_result
from modspark.plans.video import moderate_video, page_columns
from modspark.sources.detections import (
    assemble_pages,
    parse_detections,
    parse_job_notices,
    parse_video_pages,
    read_job_notices,
)
from modspark.sources.objects import (
    list_media_objects,
    parse_object_events,
    parse_transcripts,
    read_by_folders,
    read_object_events,
    read_text_objects,
    read_transcripts,
    write_text_objects,
)
from modspark.sources.results import (
    compact_buckets,
    compact_store,
    latest_per_key,
    read_latest,
    result_documents,
    upsert_latest,
    write_results,
)
from modspark.streaming.jobs import stream_match_jobs
from modspark.streaming.moderation import stream_moderation
