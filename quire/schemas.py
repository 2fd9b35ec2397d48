"""Schemas of the documents that sources read and sinks write."""

from __future__ import annotations

BBOX = "struct<x1:double,y1:double,x2:double,y2:double>"
META = "struct<label:string,confidence:double,version_id:string,panel_image:string,reading_order:string,skipped:boolean,skip_reason:string>"
BLOCK = f"struct<block_id:string,block_type:string,bbox:array<double>,order:int,crop_path:string,raw_text:string,latex:string,meta:{META}>"
LAYOUT = f"version int, source string, pdf string, pages array<struct<page:int,image_path:string,blocks:array<{BLOCK}>>>"
SEGMENT = "struct<kind:string,text:string,source_block_id:string,bbox:array<double>,integrity:string,crop_relpath:string,version_id:string>"
PAGE_IR = f"pages array<struct<page_index:int,segments:array<{SEGMENT}>>>"
SEGMENT_ROWS = "page_index int, pos int, kind string, text string, source_block_id string, version_id string"
NUP = "page_index int, `class` string, confidence double, threshold double, fallback boolean, panels array<struct<version_id:string,bbox:array<double>,path:string,semantic:string>>"
MANIFEST = "done_schema int, job_id string, doc_id string, created_at string, source_pdf string, artifacts array<struct<path:string,sha256:string>>, ocr_pipeline_version string"
CHAT = "id string, status string, language string, notes string, has_figure boolean, figure_description string, source struct<pdf:string,page:int,question_id:string,image:string,lang:string>, messages array<struct<role:string,content:string>>"

BLOCK_TYPES = ["text", "title", "list", "formula", "equation", "table", "figure", "other"]
KINDS = ["prose", "math", "mark_note", "figure"]
STATUSES = ["ok", "repaired", "fail"]
