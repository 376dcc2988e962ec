"""Explicit schemas (Spark DDL).  All fields are nullable, unknown fields are ignored."""

_BOX = "STRUCT<Width:DOUBLE, Height:DOUBLE, Left:DOUBLE, Top:DOUBLE>"
_FLAG = "STRUCT<Value:BOOLEAN, Confidence:DOUBLE>"
_POINTS = "ARRAY<STRUCT<Type:STRING, X:DOUBLE, Y:DOUBLE>>"
_POSE = "STRUCT<Roll:DOUBLE, Yaw:DOUBLE, Pitch:DOUBLE>"
_QUALITY = "STRUCT<Brightness:DOUBLE, Sharpness:DOUBLE>"
_EMOTIONS = "ARRAY<STRUCT<Type:STRING, Confidence:DOUBLE>>"

FACE = f"""STRUCT<BoundingBox:{_BOX}, AgeRange:STRUCT<Low:INT, High:INT>, Smile:{_FLAG},
  Eyeglasses:{_FLAG}, Sunglasses:{_FLAG}, Gender:STRUCT<Value:STRING, Confidence:DOUBLE>,
  Beard:{_FLAG}, Mustache:{_FLAG}, EyesOpen:{_FLAG}, MouthOpen:{_FLAG}, Emotions:{_EMOTIONS},
  Landmarks:{_POINTS}, Pose:{_POSE}, Quality:{_QUALITY}, Confidence:DOUBLE, FaceOccluded:{_FLAG},
  EyeDirection:STRUCT<Yaw:DOUBLE, Pitch:DOUBLE, Confidence:DOUBLE>>"""

CELEBRITY_FACE = f"""STRUCT<BoundingBox:{_BOX}, Confidence:DOUBLE, Landmarks:{_POINTS},
  Pose:{_POSE}, Quality:{_QUALITY}, Emotions:{_EMOTIONS}, Smile:{_FLAG}>"""

# Boolean-valued face attributes, in output order.
FACE_FLAGS = ["Smile", "Eyeglasses", "Sunglasses", "Beard", "Mustache", "EyesOpen", "MouthOpen",
              "FaceOccluded"]

DETECTIONS = {
    "moderation": "ModerationLabels ARRAY<STRUCT<Confidence:DOUBLE, Name:STRING, ParentName:STRING>>, "
                  "ModerationModelVersion STRING",
    "faces": f"FaceDetails ARRAY<{FACE}>",
    "celebrities": f"""CelebrityFaces ARRAY<STRUCT<Urls:ARRAY<STRING>, Name:STRING, Id:STRING,
        Face:{CELEBRITY_FACE}, MatchConfidence:DOUBLE, KnownGender:STRUCT<Type:STRING>>>,
        UnrecognizedFaces ARRAY<{CELEBRITY_FACE}>""",
    "image_text": f"""TextDetections ARRAY<STRUCT<DetectedText:STRING, Type:STRING, Id:INT,
        ParentId:INT, Confidence:DOUBLE, Geometry:STRUCT<BoundingBox:{_BOX},
        Polygon:ARRAY<STRUCT<X:DOUBLE, Y:DOUBLE>>>>>, TextModelVersion STRING""",
    "pii": "Entities ARRAY<STRUCT<Score:DOUBLE, Type:STRING, BeginOffset:INT, EndOffset:INT>>",
    "sentiment": "Sentiment STRING, SentimentScore STRUCT<Positive:DOUBLE, Negative:DOUBLE, "
                 "Neutral:DOUBLE, Mixed:DOUBLE>",
    "languages": "Languages ARRAY<STRUCT<LanguageCode:STRING, Score:DOUBLE>>",
    "toxic_text": "ResultList ARRAY<STRUCT<Labels:ARRAY<STRUCT<Name:STRING, Score:DOUBLE>>, "
                  "Toxicity:DOUBLE>>",
    "classes": "Classes ARRAY<STRUCT<Name:STRING, Score:DOUBLE>>",
}

OBJECT_EVENTS = """Records ARRAY<STRUCT<eventVersion:STRING,
  eventTime:TIMESTAMP, eventName:STRING, s3:STRUCT<s3SchemaVersion:STRING, configurationId:STRING,
    bucket:STRUCT<name:STRING, arn:STRING>,
    object:STRUCT<key:STRING, size:BIGINT, eTag:STRING, sequencer:STRING>>>>"""

TRANSCRIPT = """jobName STRING, status STRING, results STRUCT<
  transcripts:ARRAY<STRUCT<transcript:STRING>>,
  items:ARRAY<STRUCT<type:STRING, alternatives:ARRAY<STRUCT<confidence:STRING, content:STRING>>,
    start_time:STRING, end_time:STRING>>,
  toxicity_detection:ARRAY<STRUCT<start_time:DOUBLE, end_time:DOUBLE, text:STRING,
    toxicity:DOUBLE, categories:MAP<STRING,DOUBLE>>>>"""

NOTICE_BODY = "Message STRING"
NOTICE_MESSAGE = "JobId STRING, Status STRING"

VIDEO_METADATA = "STRUCT<Codec:STRING, DurationMillis:BIGINT, Format:STRING, FrameRate:DOUBLE>"

VIDEO_PAGE = f"""VideoMetadata {VIDEO_METADATA}, NextToken STRING,
  Labels ARRAY<STRUCT<Timestamp:BIGINT, Label:STRUCT<Name:STRING, Confidence:DOUBLE>>>,
  ModerationLabels ARRAY<STRUCT<Timestamp:BIGINT,
    ModerationLabel:STRUCT<Name:STRING, Confidence:DOUBLE, ParentName:STRING>>>,
  Faces ARRAY<STRUCT<Timestamp:BIGINT, Face:{FACE}>>,
  Persons ARRAY<STRUCT<Timestamp:BIGINT, Person:STRUCT<Index:BIGINT>,
    FaceMatches:ARRAY<STRUCT<Similarity:DOUBLE, Face:STRUCT<FaceId:STRING>>>>>,
  Celebrities ARRAY<STRUCT<Timestamp:BIGINT, Celebrity:STRUCT<Name:STRING>>>"""
