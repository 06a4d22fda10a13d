"""The quality rules as SQL conditions for DuckDB, written apart from the library's columns.

Each entry is (rule number, condition, message); rows are keyed by rule family.
"""

# Rule numbers, messages and code lists.
RULE_SQL: dict[str, list[tuple[int, str, str]]] = {
    "all": [
        (1, 'NOT coalesce("rec_type", \'\') IN (\'I\', \'E\')', 'Invalid rec type'),
        (2, '"rec_type" = \'I\' AND NOT (upper(coalesce("b_g", \'\')) IN (\'B\', \'G\', \'A\') OR trim(coalesce("b_g", \'\')) = \'\')', 'Invalid B_G indicator'),
        (78, 'trim(coalesce("gpi", \'\')) = \'\' AND trim(coalesce("ndc11", \'\')) = \'\' AND trim(coalesce("ndc9", \'\')) = \'\'', 'GPI and NDC are blank'),
        (86, 'contains(coalesce("ndc9", \'\'), \'*\')', 'Invalid NDC9'),
        (87, 'contains(coalesce("ndc11_raw", \'\'), \'*\') AND "sql_join" <> \'WILDCARD\'', 'Invalid NDC11'),
        (88, 'contains(coalesce("ndc9", \'\'), \'-\')', 'Invalid NDC9'),
        (89, 'contains(coalesce("ndc11", \'\'), \'-\')', 'Invalid NDC11'),
        (90, 'contains(coalesce("ndc9", \'\'), \',\') OR contains(coalesce("ndc11", \'\'), \',\') OR contains(coalesce("rec_type", \'\'), \',\') OR contains(coalesce("gpi", \'\'), \',\') OR contains(coalesce("b_g", \'\'), \',\') OR contains(coalesce("ms_ss", \'\'), \',\') OR contains(coalesce(cast("age_min" as varchar), \'\'), \',\') OR contains(coalesce(cast("age_max" as varchar), \'\'), \',\')', 'Multiple values separated by comma in one cell'),
        (91, 'trim(coalesce("ndc9", \'\')) <> \'\' AND length(coalesce("ndc9", \'\')) <> 9', 'Invalid NDC9 length'),
        (92, 'trim(coalesce("ndc11", \'\')) <> \'\' AND length(coalesce("ndc11", \'\')) <> 11 AND "sql_join" <> \'WILDCARD\'', 'Invalid NDC11 length'),
        (93, 'trim(coalesce("gpi", \'\')) <> \'\' AND "gpi_len" NOT IN (2, 4, 6, 8, 10, 12, 14)', 'Invalid GPI length'),
        (94, 'trim(coalesce("gpi", \'\')) <> \'\' AND length(coalesce("gpi", \'\')) > 14', 'Invalid GPI length'),
        (95, 'trim(coalesce("gpi", \'\')) <> \'\' AND contains(coalesce("gpi_raw", \'\'), \'*\') AND "ast" <= length(replace(coalesce("gpi_raw", \'\'), \'*\', \'\'))', 'Invalid GPI'),
        (96, 'trim(coalesce("gpi", \'\')) <> \'\' AND substr(coalesce("gpi_raw", \'\'), 1, 1) = \'*\'', 'Invalid GPI'),
        (97, 'trim(coalesce("gpi", \'\')) <> \'\' AND NOT coalesce("b_g", \'\') IN (\'B\', \'G\', \'A\')', 'B_G must be specified with GPI'),
        (98, 'trim(coalesce("gpi", \'\')) <> \'\' AND NOT coalesce("ms_ss", \'\') IN (\'SS\', \'MS\', \'A\')', 'MS_SS must be specified with GPI'),
        (99, 'contains(coalesce("ndc9", \'\'), \'E\') AND contains(coalesce("ndc9", \'\'), \'.\')', 'Invalid NDC9'),
        (100, 'contains(coalesce("ndc11", \'\'), \'E\') AND contains(coalesce("ndc11", \'\'), \'.\')', 'Invalid NDC11'),
        (101, 'contains(coalesce("gpi", \'\'), \'E\') AND contains(coalesce("gpi", \'\'), \'.\')', 'Invalid GPI'),
        (102, 'contains(coalesce("ndc9", \'\'), \'e\') AND contains(coalesce("ndc9", \'\'), \'.\')', 'Invalid NDC9'),
        (103, 'contains(coalesce("ndc11", \'\'), \'e\') AND contains(coalesce("ndc11", \'\'), \'.\')', 'Invalid NDC11'),
        (104, 'contains(coalesce("gpi", \'\'), \'e\') AND contains(coalesce("gpi", \'\'), \'.\')', 'Invalid GPI'),
    ],
    "fdro": [
        (3, 'NOT (upper(coalesce("GRDFTHR", \'\')) IN (\'N\', \'Y\', \'M\') OR trim(coalesce("GRDFTHR", \'\')) = \'\')', 'Invalid GRDFTHR'),
        (4, 'NOT upper(coalesce("class", \'\')) IN (\'OTHER\', \'MSB\', \'SPECIALTY\', \'STRIPS/KITS\')', 'Invalid Class Value'),
        (5, 'trim(coalesce("Lbl_Name", \'\')) = \'\'', 'Label Name cannot be blank'),
        (6, 'trim(coalesce("XDRUG_TEXT", \'\')) = \'\'', 'XDrug Text cannot be blank'),
        (7, 'trim(coalesce("DRUGMSG", \'\')) = \'\'', 'Drug Message cannot be blank'),
        (8, 'trim(coalesce("GSTP_ALTERNATIVE_TEXT", \'\')) = \'\'', 'GSTP Alternative Text cannot be blank'),
        (9, 'trim(coalesce("MDXSTELLENT", \'\')) = \'\'', 'MDXSTELLENT cannot be blank'),
        (10, 'trim(coalesce("MDPASTELLENT", \'\')) = \'\'', 'MDPASTELLENT cannot be blank'),
        (11, 'trim(coalesce("PTXSTELLENT", \'\')) = \'\'', 'PTXSTELLENT cannot be blank'),
        (12, 'trim(coalesce("PTPASTELLENT", \'\')) = \'\'', 'PTPASTELLENT cannot be blank'),
        (13, '(trim(coalesce("PTHYPERSTELLENT", \'\')) <> \'\' OR trim(coalesce("MDHYPERSTELLENT", \'\')) <> \'\') AND trim(coalesce("HYPER_ALTERNATIVE_TEXT", \'\')) = \'\'', 'HYPER ALTERNATIVE TEXT cannot be blank'),
        (14, '(trim(coalesce("PTHYPERSTELLENT", \'\')) <> \'\' OR trim(coalesce("MDHYPERSTELLENT", \'\')) <> \'\') AND trim(coalesce("HYPER_GSTP_ALTERNATIVE_TEXT", \'\')) = \'\'', 'HYPER GSTP ALTERNATIVE TEXT cannot be blank'),
        (15, 'NOT coalesce("INSULIN_CALL", \'\') IN (\'N\', \'Y\')', 'Invalid Insulin calls Value'),
        (16, '"rec_type" = \'I\' AND trim(coalesce("alternative_text", \'\')) = \'\'', 'Alternative Messaging cannot be blank'),
        (17, 'trim(coalesce("add_back_messaging", \'\')) <> \'\' AND trim(coalesce("PTXAddbkStellent", \'\')) = \'\'', 'PTXAddbkStellent cannot be blank'),
        (18, 'trim(coalesce("add_back_messaging", \'\')) <> \'\' AND trim(coalesce("PTPAAddbkStellent", \'\')) = \'\'', 'PTPAAddbkStellent cannot be blank'),
        (19, 'trim(coalesce("add_back_messaging_hyper", \'\')) <> \'\' AND trim(coalesce("PTHyperAddbk", \'\')) = \'\'', 'PTHyperAddbk cannot be blank'),
        (20, 'NOT (coalesce("add_back_merge_drug_hyper_ind", \'\') IN (\'Y\', \'N\') OR trim(coalesce("add_back_merge_drug_hyper_ind", \'\')) = \'\')', 'Invalid Add Back Merge Drug Hyper indicator Value'),
        (21, 'NOT coalesce("RXCHANGE_SPC", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_SPC Value'),
        (22, 'NOT coalesce("RXCHANGE_MAIL", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_MAIL Value'),
        (23, 'NOT coalesce("RXCHANGE_RETAIL", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_RETAIL Value'),
    ],
    "acf": [
        (24, 'NOT (coalesce("GF", \'\') IN (\'Y\', \'N\', \'M\') OR trim(coalesce("GF", \'\')) = \'\')', 'Invalid GrandFather Flag'),
        (25, 'length(coalesce("insulin calls", \'\')) > 12', 'Invalid Length of Insulin calls'),
        (26, 'length(coalesce("DRUG NAME", \'\')) > 100', 'Invalid Length of Drung Name'),
        (27, 'length(coalesce("PT_LTR", \'\')) > 30', 'Invalid Length of PT_LTR'),
        (28, 'length(coalesce("Add-back PT_LTR", \'\')) > 30', 'Invalid Length of Add_back_PT_LTR'),
        (29, 'length(coalesce("Insert", \'\')) > 30', 'Invalid Length of pt_Insert'),
        (30, 'length(coalesce("PT_LTR_RETAIL", \'\')) > 30', 'Invalid Length of PT_LTR_RETAIL'),
        (31, 'length(coalesce("Add-back_Retail", \'\')) > 30', 'Invalid Length of Add_back_Retail'),
        (32, 'length(coalesce("MD_LTR", \'\')) > 30', 'Invalid Length of MD_LTR'),
        (33, 'length(coalesce("VF_ACSF_PT_LTR", \'\')) > 30', 'Invalid Length of VF_ACSF_PT_LTR'),
        (34, 'length(coalesce("VF-ACSF_MD_LTR", \'\')) > 30', 'Invalid Length of VF_ACSF_MD_LTR'),
        (35, 'length(coalesce("Add-Back Merge Field", \'\')) > 300', 'Invalid Length of Add_Back_Merge_Field'),
        (36, 'length(coalesce("include or exclude", \'\')) > 1', 'Invalid Length of Include_or_Exclude'),
        (37, '"rec_type" = \'I\' AND trim(coalesce("alternative_text", \'\')) = \'\'', 'Alternative Messaging cannot be blank'),
        (38, 'NOT coalesce("RXCHANGE_SPC", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_SPC Value'),
        (39, 'NOT coalesce("RXCHANGE_MAIL", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_MAIL Value'),
        (40, 'NOT coalesce("RXCHANGE_RETAIL", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_RETAIL Value'),
    ],
    "bc": [
        (41, 'NOT coalesce("PUE FLAG", \'\') IN (\'Y\', \'N\', \'M\')', 'Invalid PUE Flag'),
        (42, 'NOT coalesce("SPCLTY MANAGED", \'\') IN (\'Y\', \'N\')', 'Invalid Speciality Managed'),
        (43, 'NOT (coalesce("CALL TYPE", \'\') IN (\'E\', \'S\', \'N\') OR trim(coalesce("CALL TYPE", \'\')) = \'\')', 'Invalid Call Type'),
        (44, '"EFFECTIVE DATE" IS NULL', 'Invalid Effective Date'),
        (45, 'length(coalesce("NDC", \'\')) <> 11', 'Invalid NDC 11'),
        (46, 'trim(coalesce("DRUG LABEL NAME", \'\')) = \'\'', 'Invalid Drug Label Name'),
        (47, 'length(coalesce("DRUG LABEL NAME", \'\')) > 100', 'Invalid Length Drug Label Name'),
        (48, 'trim(coalesce("DRUG BRAND NAME", \'\')) = \'\'', 'Invalid Drug Brand Name'),
        (49, 'length(coalesce("DRUG BRAND NAME", \'\')) > 100', 'Invalid Length Of Drug Brand Name'),
        (50, 'trim(coalesce("DRUG ABBR NAME", \'\')) = \'\'', 'Invalid Drug Abbrevation Name'),
        (51, 'length(coalesce("DRUG ABBR NAME", \'\')) > 100', 'Invalid Length of Drug Abbrevation Name'),
        (52, 'trim(coalesce("ALTERNATIVES", \'\')) = \'\'', 'Invalid Alternative Text'),
        (53, 'length(coalesce("ALTERNATIVES", \'\')) > 300', 'Invalid Length of Alternative Text'),
        (54, 'NOT coalesce("ADD BACK", \'\') IN (\'Y\', \'N\')', 'Invalid Add Back'),
        (55, 'length(coalesce("ADD BACK LANGUAGE", \'\')) > 300', 'Invalid Length of Add Back Language'),
        (56, 'NOT coalesce("PRODUCT CODE", \'\') IN (\'SP-PDPD\', \'FE-MNPA\', \'FE-TS\')', 'Invalid Product Code'),
        (57, 'trim(coalesce("MEMBER LETTER TEMPLATE ID", \'\')) = \'\'', 'Invalid Member Letter Template Id'),
        (58, 'length(coalesce("MEMBER LETTER TEMPLATE ID", \'\')) > 30', 'Invalid Length of Member Letter Template Id'),
        (59, 'length(coalesce("MEMBER LETTER INSERT TEMPLATE ID", \'\')) > 30', 'Invalid Length of Member Letter Insert Template Id'),
        (60, 'length(coalesce("ADD BACK MEMBER LETTER TEMPLATE", \'\')) > 30', 'Invalid Length of Add Back Member Letter Template'),
        (61, 'length(coalesce("ADD BACK MEMBER LETTER INSERT TE", \'\')) > 30', 'Invalid Length of Add Back Member Letter Insert Template'),
        (62, 'length(coalesce("MEMBER CALL TEMPLATE ID", \'\')) > 30', 'Invalid Length of Member Call Template Id'),
        (63, 'trim(coalesce("PRESCRIBER LETTER TEMPLATE ID", \'\')) = \'\'', 'Invalid Prescriber Letter Template Id'),
        (64, 'length(coalesce("PRESCRIBER LETTER TEMPLATE ID", \'\')) > 30', 'Invalid Length of Prescriber Letter Template Id'),
        (65, 'trim(coalesce("GSTP ALTERNATIVES", \'\')) = \'\'', 'GSTP ALTERNATIVE TEXT Cannot be blank'),
        (66, '"ADD BACK" = \'Y\' AND (trim(coalesce("ADD BACK LANGUAGE", \'\')) = \'\' OR trim(coalesce("ADD BACK MEMBER LETTER TEMPLATE", \'\')) = \'\')', 'Invalid Add Back Yes Message'),
        (67, '"ADD BACK" = \'N\' AND (trim(coalesce("ADD BACK LANGUAGE", \'\')) <> \'\' OR trim(coalesce("ADD BACK MEMBER LETTER TEMPLATE", \'\')) <> \'\')', 'Invalid Add Back No Message'),
        (68, 'NOT coalesce("RXCHANGE_SPC", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_SPC Value'),
        (69, 'NOT coalesce("RXCHANGE_MAIL", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_MAIL Value'),
        (70, 'NOT coalesce("RXCHANGE_RETAIL", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_RETAIL Value'),
    ],
    "tier": [
        (71, '"rec_type" = \'I\' AND NOT (upper(coalesce("ms_ss", \'\')) IN (\'M\', \'S\', \'A\') OR trim(coalesce("ms_ss", \'\')) = \'\')', 'Invalid MS_SS indicator'),
    ],
    "nottier": [
        (72, '"rec_type" = \'I\' AND NOT (upper(coalesce("ms_ss", \'\')) IN (\'MS\', \'SS\', \'A\') OR trim(coalesce("ms_ss", \'\')) = \'\')', 'Invalid MS_SS indicator'),
    ],
    "hix": [
        (73, 'NOT coalesce("RXCHANGE_SPC", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_SPC Value'),
        (74, 'NOT coalesce("RXCHANGE_MAIL", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_MAIL Value'),
        (75, 'NOT coalesce("RXCHANGE_RETAIL", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_RETAIL Value'),
    ],
    "gstp": [
        (76, '"rec_type" = \'I\' AND trim(coalesce("alternative_text", \'\')) = \'\'', 'Alternative Messaging cannot be blank'),
    ],
    "bal": [
        (77, '"rec_type" = \'I\' AND coalesce("change_type", \'\') IN (\'EX\', \'ST\') AND trim(coalesce("alternative_text", \'\')) = \'\'', 'Alternative Messaging cannot be blank'),
    ],
    "intake": [
        (79, '(case when trim(coalesce("ndc11", \'\')) <> \'\' then 1 else 0 end + case when trim(coalesce("ndc9", \'\')) <> \'\' then 1 else 0 end + case when trim(coalesce("gpi", \'\')) <> \'\' then 1 else 0 end) > 1', 'Only 1 of NDC11, NDC9 or GPI can be populated'),
        (105, '"_exceedlmt" <> \'000000\' AND substr("_exceedlmt", 1, 1) = \'1\'', 'retail qty limit exceeds 200 char'),
        (105, '"_exceedlmt" <> \'000000\' AND substr("_exceedlmt", 2, 1) = \'1\'', 'retail qty unit exceeds 200 char'),
        (105, '"_exceedlmt" <> \'000000\' AND substr("_exceedlmt", 3, 1) = \'1\'', 'retail qty time exceeds 200 char'),
        (105, '"_exceedlmt" <> \'000000\' AND substr("_exceedlmt", 4, 1) = \'1\'', 'mail qty limit exceeds 200 char'),
        (105, '"_exceedlmt" <> \'000000\' AND substr("_exceedlmt", 5, 1) = \'1\'', 'mail qty unit exceeds 200 char'),
        (105, '"_exceedlmt" <> \'000000\' AND substr("_exceedlmt", 6, 1) = \'1\'', 'mail qty time exceeds 200 char'),
        (106, '"_exceed_rlimit" = 1', 'Combined retail quantity limit fields exceeds 200 char'),
        (107, '"_exceed_mlimit" = 1', 'Combined mail quantity limit fields exceeds 200 char'),
    ],
    "bf": [
        (80, 'trim(coalesce("gf", \'\')) <> \'\' AND NOT upper(coalesce("gf", \'\')) IN (\'N\', \'Y\', \'M\')', 'Invalid GF'),
        (81, 'NOT coalesce("RXCHANGE_SPC", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_SPC Value'),
        (82, 'NOT coalesce("RXCHANGE_MAIL", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_MAIL Value'),
        (83, 'NOT coalesce("RXCHANGE_RETAIL", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_RETAIL Value'),
    ],
    "vf": [
        (108, 'NOT coalesce("PUE_FLAG", \'\') IN (\'Y\', \'M\', \'N\')', 'Invalid PUE FLAG'),
        (109, 'NOT coalesce("SPECIALTY_MANAGED_PRODUCT", \'\') IN (\'Y\', \'N\')', 'Invalid SPECIALTY MANAGED PRODUCT'),
        (110, 'NOT (coalesce("CALL_TYPE", \'\') IN (\'I\', \'N\', \'S\') OR trim(coalesce("CALL_TYPE", \'\')) = \'\')', 'Invalid Call Type'),
        (111, '"EFF_DATE" IS NULL', 'Invalid EFF DATE'),
        (112, 'length(coalesce("DRUG LABEL NAME", \'\')) > 100', 'DRUG LABLE NAME exceeds 100 chars'),
        (113, 'trim(coalesce("DRUG LABEL NAME", \'\')) = \'\'', 'DRUG LABEL NAME cannot be blank'),
        (114, 'length(coalesce("DRUG BRAND NAME", \'\')) > 50', 'DRUG BRAND NAME exceeds 50 chars'),
        (115, 'trim(coalesce("DRUG BRAND NAME", \'\')) = \'\'', 'DRUG BRAND NAME cannot be blank'),
        (116, 'length(coalesce("DRUG ABBR NAME", \'\')) > 50', 'DRUG ABBR NAME exceeds 50 chars'),
        (117, 'trim(coalesce("DRUG ABBR NAME", \'\')) = \'\'', 'DRUG ABBR NAME cannot be blank'),
        (118, 'NOT coalesce("CHANGE_TYPE_PBM", \'\') IN (\'PA\', \'QL\', \'DNT\') AND trim(coalesce("PBM_ALTERNATIVE", \'\')) = \'\'', 'PBM ALTERNATIVE cannot be blank'),
        (119, 'NOT coalesce("CHANGE_TYPE_MDDB", \'\') IN (\'PA\', \'QL\', \'DNT\') AND trim(coalesce("MDDB_ALTERNATIVE", \'\')) = \'\'', 'MDB ALTERNATIVE cannot be blank'),
        (120, 'trim(coalesce("PBM_ADD_BACK_PRODUCT", \'\')) <> \'\' AND trim(coalesce("PBM_ADD_BACK_TEMPLATE", \'\')) = \'\'', 'PBM ADD BACK TEMPLATE must be populated for add back'),
        (121, 'trim(coalesce("PBM_ADD_BACK_PRODUCT", \'\')) = \'\' AND trim(coalesce("PBM_ADD_BACK_TEMPLATE", \'\')) <> \'\'', 'PBM ADD BACK PRODUCT must be populated for add back'),
        (122, 'trim(coalesce("MDDB_ADD_BACK_PRODUCT", \'\')) <> \'\' AND trim(coalesce("MDDB_ADD_BACK_TEMPLATE", \'\')) = \'\'', 'MDB ADD BACK TEMPLATE must be populated for add back'),
        (123, 'trim(coalesce("MDDB_ADD_BACK_PRODUCT", \'\')) = \'\' AND trim(coalesce("MDDB_ADD_BACK_TEMPLATE", \'\')) <> \'\'', 'MDB ADD BACK PRODUCT must be populated for add back'),
        (124, 'NOT coalesce("PBM_MONY_CODE", \'\') IN (\'M\', \'O\', \'N\', \'Y\')', 'Invalid PBM MONY CODE'),
        (125, 'NOT coalesce("MDDB_MONY_CODE", \'\') IN (\'M\', \'O\', \'N\', \'Y\')', 'Invalid MDDB MONY CODE'),
        (126, 'trim(coalesce("FORMULARY_DESCRIPTION_PBM", \'\')) = \'\'', '1565 FORMULARY DESCRIPTION - PBM cannot be blank'),
        (127, 'NOT coalesce("CHANGE_TYPE_PBM", \'\') IN (\'FE\', \'FE-TS\', \'LC-CO\', \'LC-ED\', \'LC-FERT\', \'LC-HSDD\', \'LC-OB\', \'PA\', \'QL\', \'SP\', \'ST\', \'DNT\')', 'Invalid 1565 CHANGE TYPE - PBM'),
        (128, 'NOT coalesce("FORMULARY_GROUP_PBM", \'\') IN (\'F\', \'NF\')', 'Invalid FORMULARY GROUP - PBM'),
        (129, 'trim(coalesce("FORMULARY_DESCRIPTION_MDDB", \'\')) = \'\'', '1565 FORMULARY DESCRIPTION - MDDB cannot be blank'),
        (130, 'NOT coalesce("CHANGE_TYPE_MDDB", \'\') IN (\'FE\', \'FE-TS\', \'LC-CO\', \'LC-ED\', \'LC-FERT\', \'LC-HSDD\', \'LC-OB\', \'PA\', \'QL\', \'SP\', \'ST\', \'DNT\')', 'Invalid 1565 CHANGE TYPE - MDDB'),
        (131, 'NOT coalesce("FORMULARY_GROUP_MDDB", \'\') IN (\'F\', \'NF\')', 'Invalid FORMULARY GROUP - MDDB'),
        (132, '("CHANGE_TYPE_PBM" = \'QL\' OR "CHANGE_TYPE_MDDB" = \'QL\') AND "retail_qty_Limit" IS NULL', 'RETAIL QUANTITY LIMIT - QTY must be populated for QL'),
        (133, '("CHANGE_TYPE_PBM" = \'QL\' OR "CHANGE_TYPE_MDDB" = \'QL\') AND "retail_qty_time" IS NULL', 'RETAIL QUANTITY LIMIT - DAYS must be populated for QL'),
        (134, '("CHANGE_TYPE_PBM" = \'QL\' OR "CHANGE_TYPE_MDDB" = \'QL\') AND trim(coalesce("retail_qty_unit", \'\')) = \'\'', 'RETAIL QUANTITY LIMIT - UNITS must be populated for QL'),
        (135, '("CHANGE_TYPE_PBM" = \'QL\' OR "CHANGE_TYPE_MDDB" = \'QL\') AND "mail_qty_limit" IS NULL', 'MAIL QUANTITY LIMIT - QTY must be populated for QL'),
        (136, '("CHANGE_TYPE_PBM" = \'QL\' OR "CHANGE_TYPE_MDDB" = \'QL\') AND "mail_qty_time" IS NULL', 'MAIL QUANTITY LIMIT - DAYS must be populated for QL'),
        (137, '("CHANGE_TYPE_PBM" = \'QL\' OR "CHANGE_TYPE_MDDB" = \'QL\') AND trim(coalesce("mail_qty_unit", \'\')) = \'\'', 'MAIL QUANTITY LIMIT - UNITS must be populated for QL'),
        (138, 'coalesce("CALL_TYPE", \'\') IN (\'I\', \'S\') AND (coalesce("CALL_TEMPLATE", \'\') IN (\'NA\') OR trim(coalesce("CALL_TEMPLATE", \'\')) = \'\')', 'CALL TEMPLATE must be populated for Call Types'),
        (139, '(coalesce("CALL_TYPE", \'\') IN (\'N\') OR trim(coalesce("CALL_TYPE", \'\')) = \'\') AND NOT (coalesce("CALL_TEMPLATE", \'\') IN (\'NA\') OR trim(coalesce("CALL_TEMPLATE", \'\')) = \'\')', 'Call type invalid for populated CALL TEMPLATE'),
        (140, 'trim(coalesce("MBR_LETTER_PBM", \'\')) = \'\'', 'MBR LETTER - PBM cannot be blank'),
        (141, 'trim(coalesce("MBR_LETTER_INSERT_PBM", \'\')) = \'\'', 'MBR LETTER INSERT - PBM cannot be blank'),
        (142, 'trim(coalesce("MBR_LETTER_PA_PBM", \'\')) = \'\'', 'MBR LETTER PA - PBM cannot be blank'),
        (143, 'trim(coalesce("MBR_LETTER_BE_PBM", \'\')) = \'\'', 'MBR LETTER BE - PBM cannot be blank'),
        (144, 'trim(coalesce("PRESCRIBER_LETTER_PBM", \'\')) = \'\'', 'PRESCRIBER LETTER - PBM cannot be blank'),
        (145, 'trim(coalesce("MBR_LETTER_MDDB", \'\')) = \'\'', 'MBR LETTER - PBM cannot be blank'),
        (146, 'trim(coalesce("MBR_LETTER_INSERT_MDDB", \'\')) = \'\'', 'MBR LETTER INSERT - MDDB cannot be blank'),
        (147, 'trim(coalesce("MBR_LETTER_PA_MDDB", \'\')) = \'\'', 'MBR LETTER PA - MDDB cannot be blank'),
        (148, 'trim(coalesce("MBR_LETTER_BE_MDDB", \'\')) = \'\'', 'MBR LETTER BE - MDDB cannot be blank'),
        (149, 'trim(coalesce("PRESCRIBER_LETTER_MDDB", \'\')) = \'\'', 'PRESCRIBER LETTER - MDDB cannot be blank'),
        (150, '"MBR_LETTER_PBM" = \'NA\' AND "MBR_LETTER_PA_PBM" = \'NA\' AND "MBR_LETTER_BE_PBM" = \'NA\' AND "MBR_LETTER_MDDB" = \'NA\' AND "MBR_LETTER_PA_MDDB" = \'NA\' AND "MBR_LETTER_BE_MDDB" = \'NA\'', 'All Member letter templates cannot be NA'),
        (151, '"PRESCRIBER_LETTER_PBM" = \'NA\' AND "PRESCRIBER_LETTER_MDDB" = \'NA\'', 'All Prescriber letter templates cannot be NA'),
        (152, 'NOT coalesce("RXCHANGE_SPC", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_SPC Value'),
        (153, 'NOT coalesce("RXCHANGE_MAIL", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_MAIL Value'),
        (154, 'NOT coalesce("RXCHANGE_RETAIL", \'\') IN (\'N\', \'Y\')', 'Invalid RXCHANGE_RETAIL Value'),
    ],
    "opi": [
        (155, 'upper(trim(coalesce("alternative_text", \'\'))) <> \'EXCLUDE\' AND "opioid_daily_dose_limit" IS NULL', 'Invalid Daily Dose Limit'),
        (156, 'upper(trim(coalesce("alternative_text", \'\'))) <> \'EXCLUDE\' AND trim(coalesce("opioid_daily_dose_text", \'\')) = \'\'', 'Missing Daily Dose Text'),
    ],
}


# Optional message columns: rule 84 or 85 on each of DrugMsg_IB1 to DrugMsg_IB12.
for family, number in (("ib", 84), ("csbf", 85)):
    RULE_SQL[family] = [
        (number, f"length(coalesce(\"DrugMsg_IB{i}\", '')) > 300", f"Invalid Length of DrugMsg_IB{i}")
        for i in range(1, 13)
    ]
