"""Record types as Spark schemas. The sentinel "invalid" of score files is NULL inside and written only by sinks."""

from __future__ import annotations

META = "struct<prompt_name:string,prompt_lang:string,model:string,raw_data_file_path:string,out_tokens_per_second:double>"
ANNOTATION = (
    "document_id string, scores array<double>, explanations array<string>, errors array<array<string>>, time_stamps array<bigint>, "
    f"document_processing_status array<string>, meta_information {META}"
)
RAW_DOCUMENT = "id string, text string, metadata struct<url:string,date:string,language:string,language_score:double,token_count:int>"
IR_RESULT = "metrics map<string,double>, CM map<string,map<string,bigint>>"
USAGE = "struct<prompt_tokens:bigint,completion_tokens:bigint,total_tokens:bigint,prompt_tokens_details:struct<cached_tokens:bigint>>"
BATCH_RESULT = f"custom_id string, response struct<body:struct<model:string,usage:{USAGE}>>"

# Processing states, tags, score labels, language codes with names.
STATUS = ("success", "error_server", "error_no_generated_text", "error_faulty_score", "request_collected")
TAGS = ("truncated", "detokenization_mismatch")
LABELS = (0.0, 1.0, 2.0, 3.0, 4.0, 5.0)
LANGUAGES = {
    "sq": "Albanian", "hy": "Armenian", "eu": "Basque", "bg": "Bulgarian", "hr": "Croatian", "ca": "Catalan", "cs": "Czech", "da": "Danish", "nl": "Dutch",
    "en": "English", "et": "Estonian", "fi": "Finnish", "fr": "French", "gl": "Galician", "de": "German", "el": "Greek", "hu": "Hungarian", "is": "Icelandic",
    "ga": "Irish", "it": "Italian", "lv": "Latvian", "lt": "Lithuanian", "mk": "Macedonian", "mt": "Maltese", "nb": "Norwegian Bokmål",
    "nn": "Norwegian Nynorsk", "pl": "Polish", "pt": "Portuguese", "ro": "Romanian", "sh": "Serbo-Croation", "sr": "Serbian", "sk": "Slovak",
    "sl": "Slovenian", "es": "Spanish", "sv": "Swedish", "tr": "Turkish", "uk": "Ukrainian",
}
TARGET_LANGUAGE = "{##TARGET_LANGUAGE##}"
