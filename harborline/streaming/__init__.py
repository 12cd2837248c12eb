"""harborline.streaming"""
