"""harborline.sources"""
