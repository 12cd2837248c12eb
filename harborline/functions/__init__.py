"""harborline.functions"""
