"""Readers: JSON lines, text and image folders, HTML, mail, archives and office files as typed frames."""

from folium.sources.files import binary_files, folder_members, html_pages, image_manifest, text_pages, unzip_members
from folium.sources.jsonl import read_json_any, read_jsonl
from folium.sources.mail import read_eml, read_mbox
from folium.sources.office import read_office

__all__ = ["binary_files", "folder_members", "html_pages", "image_manifest", "read_eml", "read_json_any", "read_jsonl", "read_mbox", "read_office", "text_pages", "unzip_members"]
