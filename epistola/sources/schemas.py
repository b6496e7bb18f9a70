"""Schemas of the engine's records, as DDL."""

ATTACHMENT = (
    "original_filename:string,saved_filename:string,file_path:string,relative_path:string,file_size:bigint,file_type:string,"
    "content_type:string,saved_at:string,status:string,is_inline:boolean,exclusion_reason:string,image_dimensions:string"
)
STATS = "total:int,saved:int,excluded:int,excluded_filenames:int,excluded_by_size:int,excluded_by_image_dimensions:int,unsupported:int,inline_images:int"
MAIL = (
    "thread_id string, message_id string, `from` string, `to` string, cc string, to_emails array<string>, cc_emails array<string>, subject string, "
    f"`date` string, parsed_date string, body string, char_count int, attachments array<struct<{ATTACHMENT}>>, attachments_stats struct<{STATS}>, processed_at string, raw_size bigint"
)
EXTRACTED = "file_name string, file_path string, text string, method string, confidence double, success boolean, error string"
OFFER = (
    "commercial_offer_found boolean, offer_number string, offer_date string, supplier_info struct<company:string,contact_person:string,inn:string>, end_user string, "
    "end_user_city string, intermediary string, payment_terms string, delivery_time string, delivery_terms string, valid_until string, issued_by string, "
    "equipment_items array<struct<type:string,name:string,model:string,article:string,quantity:int,unit_price:string,total_price:string,vat:string>>, "
    "total_cost string, currency string, comments string"
)
REQUEST = "`timestamp` double, result string, delay_used double, provider string"
