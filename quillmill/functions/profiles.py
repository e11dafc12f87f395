"""Values of the Chinese legal profile; operators take others just as well.

All that stands here is fixed: word lists, names and patterns that must be as they are for results
to be right, in their natural order.
"""

from __future__ import annotations

# --- fixed values: citations ---

TARGET_TYPES = ("statute", "judicial_interpretation")

#: Old single laws and the section of the civil code that took them over.
CODE_SECTIONS = {"合同法": "合同编", "担保法": "担保物权", "物权法": "物权编", "侵权责任法": "侵权责任编", "婚姻法": "婚姻家庭编", "民法总则": "总则编", "民法通则": "总则编"}
#: Section, part prefix, pattern for the chapter, pattern for chapter or section.
SECTION_RULES = (
    ("总则编", "第一编", None, None),
    ("物权编", "第二编", None, None),
    ("合同编", "第三编", None, None),
    ("担保物权", "第二编", "^(第十六章 一般规定|第十七章 抵押权|第十八章 质权|第十九章 留置权)$", None),
    ("保证合同", "第三编", None, "保证合同"),
    ("婚姻家庭编", "第五编", None, None),
    ("侵权责任编", "第七编", None, None),
)
FIXED_ROUTES = (("建设工程施工合同纠纷案件适用法律问题的解释", "JI-SPC-CONSTRUCTION-CONTRACT-DISPUTE-I-20201229"),)
GENERIC_NAMES = ("最高人民法院关于适用的解释", "关于适用的解释")
LITIGATION = {
    "civil": "最高人民法院关于适用中华人民共和国民事诉讼法的解释",
    "admin": "最高人民法院关于适用中华人民共和国行政诉讼法的解释",
    "criminal": "最高人民法院关于适用中华人民共和国刑事诉讼法的解释",
}
SYSTEM_HINTS = (("admin", "行政|行诉"), ("criminal", "刑事|刑诉"))

#: Names that are no citable law, by pattern (name without marks and white space).
UNCITABLE = (
    "(省|市|自治区|自治州|县|区).*(条例|规定|办法|细则)$",
    "(部|委|局|总局|办|会).*(规定|规则|办法|程序|细则|标准|指引|指南|制度|通则|实施意见|若干意见|复函|批复)$",
    "纪要$",
    "(暂行|试行).*(规定|办法|细则)$",
)
#: The same by whole name, a line each.
UNCITABLE_NAMES = """
上海市政府信息公开规定
最高人民法院关于适用中华人民共和国合同法若干问题的解释二
****法
上海市国有土地上房屋征收与补偿实施细则
北京市住宅专项维修资金管理办法
协调会纪要
浙江省司法鉴定管理条例
第八次全国法院民事商事审判工作会议民事部分纪要
西安市城市集中供热管理条例
西安市集中供热条例
公安机关内部执法监督工作规定
公安机关办理刑事案件程序规定
公安机关办理行政案件程序规定
公安机关鉴定规则
工商行政管理机关行政处罚程序暂行规定
工商行政管理机关行政赔偿实施办法
市场监督管理行政处罚听证办法
市场监督管理行政处罚程序规定
住房和城乡建设部房屋建筑和市政基础设施工程竣工验收备案管理办法
因工死亡职工供养亲属范围规定
关于收取城市基础设施配套费有关问题的规定
道路交通事故处理程序规定
矿业权交易规则
监督规则
人力资源社会保障部最高人民法院关于劳动人事争议仲裁与诉讼衔接有关问题的意见一
劳动争议处理条例
劳动合同法实施条例
国务院关于职工工作时间的规定
国有企业富余职工安置规定
国有土地上房屋征收评估办法
城市房地产开发经营管理条例
失业保险条例
工亡保险条例
建设工程质量保证金管理办法
建设工程质量管理办法
必须招标的工程项目规定
暂行规定
机动车交通事故责任强制保险条例
生产安全事故报告和调查处理条例
矿产资源开采登记管理办法
行政区域界线管理条例
行政区域界限管理条例
证券期货违法行为行政处罚办法
道路交通安全法实施条例
最高人民法院关于****监督程序若干问题的规定
最高人民法院关于人民法院执行工作若干问题的规定试行
最高人民法院关于人民法院赔偿委员会审理****案件程序的规定
最高人民法院关于审理劳动争议案件适用法律若干问题的解释
最高人民法院关于审理涉及夫妻债务纠纷案件适用法律有关问题的解释
最高人民法院关于审理道路事故损害赔偿案件适用若干问题的解释
最高人民法院关于适用中华人民共和国婚姻法若干问题的解释二
最高人民法院关于适用中华人民共和国民法总则诉讼时效制度若干问题的解释
最高人民法院关于适用中华人民共和国行政诉讼法若干问题的解释
最高人民法院关于溯及力和人民法院赔偿委员会受案范围问题的批复
最高人民法院关于审理拒不执行判决、裁定案件具体应用法律若干问题的解释
最高人民法院关于适用时间效力的若干规定
最高人民法院对关于担保期间债权人向保证人主张权利的方式及程序问题的请示的答复
最高人民法院关于债权人在保证期间以特快专递向保证人发出逾期贷款催收通知书但缺乏保证人对邮件签收或拒收的证据能否认定债权人向保证人主张权利的请示的复函
最高人民法院关于适用中华人民共和国担保法若干问题的解释
""".split()

#: What a normative title ends in, and what it does not hold.
NORMATIVE = "(法典|法律|法|条例|规定|解释|决定|办法|规则|纪要)$"
NOT_NORMATIVE = "合同|协议|议定书|章程|指南|细则|目录|名录|报告|汇报|说明|情况|统计表|表|清单|证书|许可证|执照|证明|授权书|通知书|告知书|答复|批复|申请书|购销合同|委托加工合同"

# --- fixed values: amendments ---

CN_NUM = "一二三四五六七八九十百千零〇○两"
STRICT_EDITS = "修改为|改为|变更为|删去|删除|增加一条|增加一款|增加一项|增加一条作为|增加一款作为|增加一项作为"
NO_REPEALED_LAW = "关于废止|关于修改|提请废止|提请修改|的决定|的议案|公告"

# --- fixed values: judgments ---

DOC_TYPE_FIELDS = "刑事|民事|行政|执行|国家赔偿|赔偿|司法赔偿"
DOC_TYPE_TAILS = "司法赔偿监督审查决定书|赔偿监督审查决定书|赔偿复议决定书|赔偿判决书|赔偿决定书|赔偿调解书|判决书|裁定书|决定书|调解书|通知书"
#: Level of trial: the case codes that stand for it.
CASE_CODES = (
    ("再审审查", "民申 行申 刑申 知民申 赔申 破申 民监 行监 刑监 知民监 赔监 破监"),
    ("再审", "民再 行再 刑再 知民再 赔再 破再"),
    ("二审", "民终 行终 刑终 知民终 知行终 知刑终 赔终 破终"),
    ("一审", "民初 行初 刑初 知民初 知行初 知刑初 赔初 破初"),
)
SPECIAL_CODES = (("刑复", "死刑复核"), ("委赔监", "赔偿委员会申诉"), ("委赔", "赔偿委员会决定"), (r"执[\x{4e00}-\x{9fa5}A-Z]*[0-9]+号", "执行程序"))
BODY_LEVELS = (
    ("本(判决|裁定)为终审", "二审"),
    ("死刑复核", "死刑复核"),
    ("再审(申请)?审查", "再审审查"),
    ("(再审|重审).{0,6}(判决|裁定|决定)", "再审"),
    ("二审", "二审"),
    ("一审", "一审"),
    ("执行(裁定|决定|异议|复议|分配|变卖|拍卖|终结|终止|恢复|追加|变更)", "执行程序"),
)
EXECUTION = (
    ("首次执行", "首次执行|首次立案|立案执行裁定"),
    ("恢复执行", "恢复执行|继续执行|中止后恢复"),
    ("终结/终止", "终结执行|终止执行|结案终结|本次执行终结|本案执行终结|终止"),
    ("执行异议", "执行异议|案外人执行异议|异议之诉|异议"),
    ("执行复议", "执行复议|复议决定|复议裁定|复议"),
    ("追加/变更被执行人", "追加被执行人|变更被执行人|追加"),
    ("拍卖/变卖", "拍卖|变卖|处置拍卖|网络司法拍卖"),
    ("执行分配", "分配|执行款分配|分配方案|分配裁定"),
    ("限高", "限制高消费|限高|限制消费"),
    ("罚款/拘留", "罚款|司法拘留|拘留|罚金"),
    ("失信名单", "失信被执行人|失信名单|纳入失信"),
    ("财产执行", "查封|冻结|扣划|划拨|搜查|控制财产|轮候查封|解除查封"),
    ("财产执行", "查封|冻结|扣划|搜查|控制|轮候"),
)
#: Sections by the lines that begin them: all systems, one system, and weak marks near a line's start.
TITLE = "^(刑事|民事|行政|执行|国家赔偿)?(判决书|裁定书|决定书|调解书|赔偿决定书|赔偿监督审查决定书)$"
SECTIONS = (
    ("案号行", r"^\s*[（(][0-9]{4}[）)][^号\n]{0,40}号\s*$"),
    ("主文", r"^(裁判主文|判决如下|裁定如下|决定如下)\s*$"),
    ("依据", r"^(依照|根据)[^。\n]{0,80}$"),
    ("理由", r"^(本院(经审理|经审查)?认为|法院认为|合议庭认为|本院意见|判决理由)\s*$"),
    ("诉辩主张", r"^(事实[与和]理由)([:：][^\n]{0,80})?$"),
    ("查明", r"^(经审理查明|本院查明|案件基本事实|查明事实)\s*$"),
    ("尾部", "^(审判长|审判员|人民陪审员|书记员|本判决为终审判决|本裁定为终审裁定)"),
    ("一审判决", r"^(原审|一审)(法院)?(判决|裁定|决定)[^。\n]{0,10}[:：]?$|^(原审|一审)[^。\n]{0,40}(判决如下|裁定如下|决定如下)"),
    ("一审查明", "^(一审法院|原审法院)(认定事实|查明|认为)[:：]?$"),
    ("一审认为", "^(一审法院认为|原审法院认为)[:：]?$"),
    ("二审争议焦点", r"^(本案)?二审[^\n]{0,6}争议焦点[:：]?$"),
    ("争议焦点", "^(本案)?争议焦点[:：]?$"),
)
SYSTEM_SECTIONS = {
    "民事": (
        ("诉讼请求", "^(诉讼请求|上诉请求|反诉请求)[:：]?$"),
        ("答辩意见", r"^(答辩|辩称|抗辩|异议)[^。\n]{0,8}[:：]?$"),
        ("证据", "^(证据(清单|目录)?|证据与理由|证据采信意见)[:：]?$"),
    ),
    "刑事": (
        ("起诉书指控", "^(起诉书指控|公诉机关指控|检察机关指控)[:：]?$"),
        ("被告人辩解与辩护意见", "^(被告人(供述与)?辩解|辩护人意见|辩护意见)[:：]?$"),
        ("证据", "^(证人证言|书证|鉴定意见|勘验检查笔录|辨认笔录|电子数据|证据(综合)?分析)[:：]?$"),
    ),
    "行政": (
        ("被诉行政行为", "^(被诉行政行为|被诉具体行政行为|行政行为概况)[:：]?$"),
        ("复议决定", "^(行政复议决定|复议情况|复议结论)[:：]?$"),
        ("诉辩主张", "^(上诉人|原告|被告|被上诉人|第三人).{0,6}(诉称|主张|辩称|意见)[:：]?$"),
        ("证据", "^(证据|证据与采信|证据证明力评判)[:：]?$"),
    ),
    "国家赔偿": (
        ("赔偿请求", "^(赔偿请求|申请赔偿事项)[:：]?$"),
        ("赔偿决定依据", "^(赔偿数额计算|赔偿项目|赔偿决定理由)[:：]?$"),
    ),
    "执行": (
        ("执行当事人", "^(申请执行人|被执行人|案外人)[：:]"),
        ("执行经过", "^(执行经过|执行查明|执行情况)[:：]?$"),
        ("执行异议", "^(执行异议|案外人执行异议|复议请求)[:：]?$"),
    ),
}
WEAK_SECTIONS = (
    ("审理经过", "^.{0,12}(本院(于.*?受理后|受理后)|依法组成合议庭|公开开庭审理|审理经过|本案现已审理终结)"),
    ("原审情况", "^.{0,12}(原审法院|一审法院).{0,12}作出[（(][0-9]{4}[）)].{0,80}(判决|裁定)"),
)
PARTY_ROLES = "上诉人|被上诉人|原告|被告|第三人|申请人|被申请人|赔偿请求人|被申诉人|申诉人|被执行人|申请执行人|案外人|法定代表人|代理人|委托(诉讼)?代理人|住所地|住址|统一社会信用代码|公民身份号码"
NO_PARTY = "诉讼请求|上诉请求|反诉请求|申请|请求|诉称|主张|答辩|辩称|辩护意见|辩护人意见|意见|陈述|情况|事实与理由|事实和理由"
FACTORS = {"self_surrender": "自首", "plead_guilty": "认罪认罚", "accessory": "从犯", "recidivist": "累犯", "confession": "坦白"}
ALL_ACCUSED = "(两|各|诸)被告人.*(均|皆)"
DENIALS = "不构成|不属于|未|没有|不予采信"
OPINION_WEIGHTS = {
    "本院认为": 3, "依法": 2, "从重": 1, "从轻": 1, "减轻": 1, "构成": 1, "证据": 1, "事实": 1, "情节": 1, "危害": 1, "认定": 1, "系从犯": 2, "认罪认罚": 2, "自首": 2, "坦白": 1,
}
#: A sentence on what is in dispute has one word of each.
DISPUTE = ("焦点|争议|辩护人|是否|不予采信", "自首|辩护|争议|焦点")

# --- fixed values: contracts ---

KEYWORDS = {
    "buy_sell": "采购 买卖 购销 供货 交货 验收",
    "lease": "租赁 出租 承租 租金 押金 续租 退租",
    "labor": "劳动合同 用工 聘用 试用期 社保 工资 加班 解除 竞业",
    "outsourcing": "服务外包 技术服务 咨询服务 运维 SLA 服务等级 里程碑 服务费",
    "nda": "保密协议 不披露协议 NDA 披露方 接收方 保密信息 保密期限",
    "software": "软件许可 使用许可 授权协议 SaaS API 数据许可 数据使用协议 DPA 著作权 用户数",
}
NDA_ANCHORS = ("保密协议", "不披露协议", r"\bNDA\b", "保密信息", "披露方", "接收方", "保密期限")
INSURANCE = "保险|保单|被保险人|投保人|身故|保险金额|现金价值|核保|退保|宽限期|保费"
#: Characters that contracts have in full width, and what they become.
FULL_WIDTH = dict(zip("：，；（）【】％．０１２３４５６７８９", ":,;()[]%.0123456789"))
#: Contract type: id, label and an asterisk if required, for each item.
PRESENCE_ITEMS = {
    "buy_sell": """
party_info 当事人信息（出卖人/买受人） *
subject 标的物名称/型号 *
quantity 数量与计量方式 *
quality 质量标准/技术规格 *
price_payment 价款与结算方式 *
delivery 交付期限/地点/方式 *
inspection 检验标准与方法/验收 *
packaging 包装与随附资料
risk_title_transfer 风险转移/所有权转移
after_sales 质保/售后
ip_warranty 知识产权不侵权保证（如适用）
breach_liability 违约责任/损害赔偿 *
dispute_resolution 争议解决（适用法/仲裁/法院） *
""",
    "lease": """
party_info 出租人/承租人信息 *
leased_property 租赁物名称/数量/状况 *
purpose 用途与使用限制 *
term 租赁期限 *
rent_payment 租金及支付期限/方式 *
delivery_return 交付/期满返还与原状恢复 *
maintenance 维修责任与费用分担 *
deposit 押金/担保（如有）
sublease_assignment 转租/转借/转让限制
risk_liability 风险承担/保险（如适用）
breach_termination 违约与解除/提前终止 *
dispute_resolution 争议解决 *
""",
    "labor": """
party_info 用人单位/劳动者信息 *
term 合同期限/试用期（如有） *
job_and_location 工作内容/岗位与地点 *
hours_leave 工作时间/休息休假 *
compensation 劳动报酬（工资标准/发放周期） *
social_insurance 社会保险/公积金约定 *
safety_conditions 劳动保护/条件/职业危害防护 *
training 培训条款（如约定）
confidentiality_noncompete 保密/竞业限制（如约定）
discipline 劳动纪律/规章制度遵守
termination 解除/终止与经济补偿 *
dispute_resolution 争议解决（仲裁/诉讼） *
""",
    "nda": """
party_info 当事人信息 *
confidential_definition 保密信息的范围/定义 *
use_scope 使用范围/目的限制 *
exceptions 保密义务例外（公开/已知/独立获得等） *
security_measures 安全措施/访问控制
term_duration 保密期限/存续期 *
return_destroy 资料返还/销毁 *
third_party 第三方披露与传递限制
ip_ownership 知识产权归属与不授予条款
breach_remedy 违约责任/禁令救济/损害赔偿 *
dispute_resolution 争议解决 *
""",
    "outsourcing": """
party_info 委托方/服务方信息 *
scope_deliverables 工作范围/交付成果与规格 *
timeline_milestones 进度/里程碑/服务期限 *
acceptance 验收标准与流程 *
fees_settlement 费用/结算/发票 *
change_control 变更管理（需求/范围/价格）
materials_ip 资料/工具/知识产权归属与许可 *
confidentiality 保密义务/数据合规 *
warranty_support 质量保证/维护支持（如有）
subcontracting 分包/人员更替限制
breach_liability 违约责任/赔偿/限责 *
termination 解除/终止与费用清算 *
dispute_resolution 争议解决 *
""",
    "software": """
party_info 许可方/被许可方信息 *
license_grant 许可范围（地域/期限/方式/是否独占） *
usage_restrictions 使用限制（并发/终端/不得反向工程等） *
delivery_support 交付方式/安装部署/技术支持
updates_maintenance 升级/维护/服务级别（SLA）
fees_audit 费用/计费方式/审计权 *
ip_ownership 知识产权归属与不授予条款 *
data_protection 数据安全/个人信息/接口调用合规
oss_thirdparty 开源与第三方组件约束（如适用）
infringement_indemnity 侵权担保与赔偿 *
restricted_clauses_compliance 技术合同限制性条款合规（民法典864） *
termination 终止/到期后的处置（停用/返还/销毁） *
dispute_resolution 争议解决 *
""",
}
PARTY_TYPES = ("natural_person", "company", "government", "other")
#: Procedure stage: the levels of trial that stand for it.
PROCEDURE_STAGES = (("first_instance", ("一审", "1", "First", "first_instance")), ("second_instance", ("二审", "2", "Second", "second_instance")))

# --- fixed values: tables ---

HEADER_TERMS = "编号 序号 序 号 模块 模块名称 模块名 项目 子项目 内容 说明 描述 服务范围 服务要求 服务标准 数量 单位 单价 合价 金额".split()
AMOUNT = r"[壹贰叁肆伍陆柒捌玖拾佰仟万亿零]+元|¥\s*[0-9][0-9,]*\.?[0-9]*"
FIXED_PRICE = "固定总价合同"

# --- fixed values: schemas ---

#: Keywords that strict tool schemas leave out.
DROPPED_KEYWORDS = frozenset(
    "$schema title examples deprecated readOnly writeOnly contentEncoding contentMediaType pattern format minLength maxLength minItems maxItems minimum maximum exclusiveMinimum exclusiveMaximum multipleOf".split()
)

# --- fixed values: dates of judgments, and the words near them ---

DATE = "[〇零○ＯO一二三四五六七八九十]{4}年[〇零一二三四五六七八九十]{1,3}月[〇零一二三四五六七八九十]{1,3}日"
JUDGED = "判决|裁定|决定|调解|赔偿|结案|审理终结"

# --- fixed values: kinds of contracts by folder ---

CONTRACT_FOLDERS = ("buy_sell", "lease", "labor", "nda", "outsourcing", "software")

# --- fixed values: categories of judgments, and what names them ---

CATEGORIES = ("刑事", "民事", "行政", "执行", "国家赔偿")
KIND_SAYS = (("赔偿", "国家赔偿"), ("执行", "执行"), ("行政", "行政"), ("民事", "民事"))
HEAD_SAYS = (("执行", "执行"), ("国家赔偿|赔偿决定书", "国家赔偿"), ("行政", "行政"), ("刑事", "刑事"))

# --- fixed values: courts named in the head of a judgment ---

COURT = r"[\x{4e00}-\x{9fa5}]{2,40}人民法院(赔偿委员会)?"
COMMITTEE = "赔偿委员会"
KINDS_OF_JUDGMENT = "判决书|裁定书|决定书|调解书"
NARRATIVE_STARTS = "请求|撤销|维持|依照|依据|判处|决定|裁定|驳回|公告"
#: Last line, counted from 0, and the points that a court in it is ahead by; beyond, COURT_LATE.
COURT_EARLY = ((5, 20), (10, 15), (20, 8))
COURT_LATE = 3

# --- fixed values: parties and their counsel ---

PARTY_CALLED = "被告人|被告|原告|被上诉人|上诉人|申请人|被申请人|再审申请人|申请执行人|被执行人|第三人|申诉人|被申诉人|赔偿请求人"
#: What a sentence on a party says of it: patterns, of which the first that matches gives its group.
GENDER = (r"，\s*(男|女)\s*，", "(男|女)[，、]", "(男|女)$")
BORN = (r"([0-9]{4}年[0-9]{1,2}月[0-9]{1,2}日)\s*出生", r"生于\s*([0-9]{4}年[0-9]{1,2}月[0-9]{1,2}日)")
LIVES = ("(?:住址|户籍所在地|户籍地|住所地|所在地|住所|住)[:：]?([^，。；]+)",)
CONVICTED = "因?犯[^\n。；]*?于[0-9]{4}年[0-9]{1,2}月[0-9]{1,2}日[^\n。；]*?判处"
HELD = "于([0-9]{4}年[0-9]{1,2}月[0-9]{1,2}日)[^。；]*?(拘留|逮捕|羁押)"
HELD_AS = {"拘留": "detained", "逮捕": "arrested", "羁押": "custody"}
PROCURATORATE = r"公诉机关(?:[:：]\s*)?([^\n。；]+?检察院)"
PROSECUTORS = r"检察员(?:[:：]?\s*)([\x{4e00}-\x{9fa5}·、，和以及 ]+?)(?:出庭|到庭|出席|参加)"
COUNSEL = r"(?:指定)?(?:辩护人|辩护律师|委托诉讼代理人|委托代理人|诉讼代理人)\s*[:：]\s*([^\n。；]+)"
FIRM = "律师事务所|法律援助|律师$"
CONFISCATED = r"(?:违法所得)?(?:人民币)?\s*([〇零一二两三四五六七八九十百千万亿0-9]+)\s*元[^，。；]*?(?:追缴|没收)"
SERVED = "从([0-9]{4}年[0-9]{1,2}月[0-9]{1,2}日)起至([0-9]{4}年[0-9]{1,2}月[0-9]{1,2}日)止"

# --- fixed values: sections inside the case number's and the parties' ---

CASE_SECTION, PARTY_SECTION, COURSE_SECTION = "案号行", "当事人信息", "审理经过"
COURSE = "本院于|受理后|依法组成合议庭|公开开庭审理|本案现已审理终结|原审法院.{0,12}作出[（(][0-9]{4}[）)]"
EMBEDDED_SECTIONS = (
    ("审理经过", "本院于|受理后|依法组成合议庭|公开开庭审理|本案现已审理终结|审理经过"),
    ("原审情况", "(?:原审法院|一审法院).{0,30}(?:判决|裁定|决定)"),
    ("诉讼请求", "(?:诉讼请求|上诉请求|反诉请求)[:：]?"),
    ("答辩意见", "(?:答辩|辩称|抗辩|意见)[:：]"),
    ("诉辩主张", "事实[与和]理由"),
    ("赔偿请求", "赔偿请求|申请赔偿事项"),
    ("赔偿决定依据", "赔偿数额计算|赔偿项目|赔偿决定理由"),
    ("被诉行政行为", "被诉(?:行政)?行为"),
    ("复议决定", "复议(?:决定|情况|结论)"),
    ("起诉书指控", "起诉书指控|公诉机关指控|检察机关指控"),
    ("被告人辩解与辩护意见", "被告人(?:供述与)?辩解|辩护意见"),
    ("证据", "证据|证人证言|鉴定意见|勘验检查笔录|辨认笔录|电子数据"),
    ("查明", "经审理查明|本院查明|案件基本事实|查明事实"),
    ("一审查明", "(?:一审法院|原审法院)(?:认定事实|查明)"),
    ("一审认", "一审法院认为|原审法院认为"),
    ("理由", "本院(?:经审理|经审查)?认为|法院认为|合议庭认为|本院意见|判决理由"),
    ("主文", "裁判主文|判决如下|裁定如下|决定如下"),
    ("依据", "^(?:依照|根据)"),
)
#: Sections that a criminal judgment's record is read from.
INTRO_SECTIONS = ("开头", "案号行", "当事人信息", "审理经过")
DEFENCE_SECTIONS = ("被告人辩解与辩护意见", "辩护意见")
OPINION_SECTIONS = ("理由", "本院认为")
HOLDING_SECTIONS = ("主文", "结果", "判决结果", "尾部")

# --- fixed values: structured citations, and graphs of cases ---

LAW_FIELDS = ("law", "name", "title", "law_name")
ARTICLE_FIELDS = ("article", "articles", "article_no")
RANGE_FIELDS = (("l", "r"), ("left", "right"), ("start", "end"), ("from", "to"))
CASE_LISTS = ("parties", "relationships", "claims", "facts", "evidence", "legal_issues", "law_candidates", "similar_judgments", "timeline")
CASE_VERSION, CASE_SOURCE = "0.1.0", "judgment"
CASE_PLACE = {"jurisdiction": "CN", "language": "zh-CN"}
