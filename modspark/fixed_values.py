"""Names, lists, thresholds and wordings that results must agree on.

Nothing in this file is logic.  Every value can be overridden by a parameter of the
operator that uses it.
"""

# File extensions per modality.  "mp4" carries both pictures and sound.
IMAGE_EXTENSIONS = ["jpg", "jpeg", "png"]
VIDEO_EXTENSIONS = ["mp4", "mov"]
AUDIO_EXTENSIONS = ["amr", "flac", "mp3", "mp4", "ogg", "webm", "wav"]
TEXT_EXTENSIONS = ["txt"]

# Thresholds and page size.
MODERATION_MIN_CONFIDENCE = 60.0
IMAGE_TEXT_MIN_CONFIDENCE = 99.0
RESULT_PAGE_SIZE = 10
CHILD_SAFETY_AGE = 14

# Decisions, degrees, job states.
DECISION_PASS = "Pass"
DECISION_REVIEW = "Human review"
RESULT_SAFE = "Safe"
RESULT_UNSAFE = "Unsafe"
DEGREES = ["None", "Low", "Med", "High"]
JOB_COMPLETED = "COMPLETED"
JOB_FAILED = "FAILED"
RESULTS_FOLDER = "content_moderation_results"

# Sentiment labels in tie order (first wins).
SENTIMENTS_BY_TIE_ORDER = ["NEGATIVE", "POSITIVE", "MIXED", "NEUTRAL"]

# Toxicity categories.
TOXICITY_CATEGORIES = [
    "profanity",
    "hate_speech",
    "sexual",
    "insult",
    "violence_or_threat",
    "graphic",
    "harassment_or_abuse",
]

# The moderation policy, ten categories in order.
POLICY = [
    ("Explicit Nudity", ["Nudity", "Graphic Male Nudity", "Graphic Female Nudity", "Sexual Activity",
                         "Illustrated Explicit Nudity", "Adult Toys"]),
    ("Suggestive", ["Female Swimwear Or Underwear", "Male Swimwear Or Underwear", "Partial Nudity",
                    "Barechested Male", "Revealing Clothes", "Sexual Situations"]),
    ("Violence", ["Graphic Violence Or Gore", "Physical Violence", "Weapon Violence", "Weapons",
                  "Self Injury"]),
    ("Visually Disturbing", ["Emaciated Bodies", "Corpses", "Hanging", "Air Crash",
                             "Explosions And Blasts"]),
    ("Rude Gestures", ["Middle Finger"]),
    ("Drugs", ["Drug Products", "Drug Use", "Pills", "Drug Paraphernalia"]),
    ("Tobacco", ["Tobacco Products", "Smoking"]),
    ("Alcohol", ["Drinking", "Alcoholic Beverages"]),
    ("Gambling", ["Gambling"]),
    ("Hate Symbols", ["Nazi Party", "White Supremacy", "Extremist"]),
]

# Prompt wording for an offline scorer.  {policy} and {text} are filled per row.
JSON_VERDICT_TEMPLATE = """The following is our company's content moderation policy, based on the moderation policy, we gather text information from the user uploaded text. Please answer the question with json format.

###### moderation policy ######
{policy}

###### text information ######
{text}

###### Question ######
Based on the following Moderation policy and QA, tell me if the photo containes unsafe content, also give its category and reason. Please anwser the question with the following format and only put explanation into the reason field:
{
    "flag": "xxx",
    "category": "xxx",
    "reason": "the reason is ..."
}
"""

LINE_VERDICT_TEMPLATE = """Human:
You are a well-trained language model for detecting inappropriate content in text.
Here is a paragraph {text}.
Your task is to critically review if the above paragraph suitable for children under 14 years old.
For example,content not good for children include but not limited to: {policy}.
If the content contain any content above, answer me with Unsafe and then select the <degree> about the degree of harm:
<degree>
None
Low
Med
High
</degree>
If the content don't contain any content above, answer me with Safe, give me <degree> with None. Whatever give me explanation of your assessment.
Answer format as follows:
'''
Result:"Safe or Unsafe"
Degree of harm:"<degree>"
Explanation
'''
Assistant:"""
